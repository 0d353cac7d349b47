"""Repeats across documents: minimizer anchors, range-partitioned and grouped by hash, in place of a suffix sort."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.arrays import U64
from tablewright.llm.shared import replaced, whole
from tablewright.session import persist_to_shared

LENGTH = 50  # bytes of a string that counts as a repeat
LEAD = 26  # leading bytes a sampled suffix is known by
REACH = LENGTH - LEAD  # a window's anchor stands at most this far from its start
MARGIN = 2 * LENGTH  # bytes around a piece that decide about anchors inside it
BUFFER = 1 << 20  # anchors a task holds before it combines and sends them
BUCKET = 1 << 20  # anchors per range of the suffix order, about
SAMPLE_DOCS = 2000  # bound of the sample the splitters are taken from
TOP = U64(2**64 - 1)

Records = tuple[np.ndarray, ...]  # key, context, document, tag, position
NONE: Records = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32))


class Piece:
    """A stretch of bytes with hashes of any substring by prefix sums."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        self.total = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * arrays.power(arrays.BASE, n), out=self.total[1:])
        self.back = arrays.power(arrays.BACK, n + 1)

    def hash(self, lo, hi) -> np.ndarray:
        return arrays.mixed((self.total[hi] - self.total[lo]) * self.back[lo])

    def leads(self) -> np.ndarray:
        n = len(self.data) - LEAD + 1
        return arrays.mixed((self.total[LEAD:] - self.total[:n]) * self.back[:n])


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` over every run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values, span = pick(values[:-span], values[span:]), span * 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, position, key, context hash) of the sampled suffixes of all documents.

    Every window of LENGTH bytes samples the suffix at its smallest lead hash, so equal windows in different
    documents sample it at the same place. The key orders suffixes by their first two bytes, then by a hash of
    the whole lead; the context is all bytes that any window with this anchor covers.
    """
    for lo in range(0, len(data), arrays.PIECE):
        hi = min(lo + arrays.PIECE, len(data))
        left, right = max(0, lo - MARGIN), min(len(data), hi + MARGIN)
        if right - left < LENGTH:
            continue
        piece = Piece(data[left:right])
        lead = piece.leads()
        edges = offsets[np.searchsorted(offsets, left, "right") : np.searchsorted(offsets, right, "left")] - left
        for e in edges:  # no lead and no window crosses from one document into the next
            lead[max(0, e - LEAD + 1) : e] = TOP
        least = sliding(lead, REACH + 1, np.minimum)
        for e in edges:
            least[max(0, e - LENGTH + 1) : e] = 0
        pad = np.zeros(REACH, U64)
        best = sliding(np.concatenate([pad, least, pad]), REACH + 1, np.maximum)
        at = np.flatnonzero((best == lead) & (lead != TOP))
        at = at[(at >= lo - left) & (at < hi - left)]
        doc = np.searchsorted(offsets, at + left, "right") - 1
        first, last = offsets[doc] - left, offsets[doc + 1] - left
        begin, end = np.maximum(at - REACH, np.maximum(first, 0)), np.minimum(at + LENGTH, np.minimum(last, right - left))
        context = arrays.mixed(piece.hash(begin, end) + (at - begin).astype(U64) * U64(64) + (end - at).astype(U64))
        head = (piece.data[at].astype(U64) << U64(56)) | (piece.data[at + 1].astype(U64) << U64(48))
        yield doc, at + left - offsets[doc], head | (lead[at] >> U64(16)), context


def open_windows(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, start, window hash) of the windows whose anchor is one of the given (document, position)."""
    where = offsets[doc] + pos
    order = np.argsort(where, kind="stable")
    where, doc = where[order], doc[order]
    for lo in range(0, len(data), arrays.PIECE):
        hi = min(lo + arrays.PIECE, len(data))
        pick = slice(*np.searchsorted(where, [lo, hi]))
        if pick.start == pick.stop:
            continue
        left, right = max(0, lo - MARGIN), min(len(data), hi + MARGIN)
        piece = Piece(data[left:right])
        n = right - left
        at, owner = where[pick] - left, doc[pick]
        first, last = np.maximum(offsets[owner] - left, 0), np.minimum(offsets[owner + 1] - left, n)
        near = at[:, None] + np.arange(-REACH, REACH + 1)
        fits = (near >= first[:, None]) & (near + LEAD <= last[:, None])
        safe = np.where(fits, near, at[:, None])
        lead = np.where(fits, piece.hash(safe, safe + LEAD), TOP)
        own = lead[:, REACH]
        before = np.minimum.accumulate(lead[:, REACH::-1], axis=1)  # [a]: least of the a leads before
        after = np.minimum.accumulate(lead[:, REACH:], axis=1)
        for a in range(REACH + 1):
            start = at - a
            good = (start >= first) & (start + LENGTH <= last) & (before[:, a] >= own) & (after[:, REACH - a] >= own)
            s, o = start[good], owner[good]
            yield o, s + left - offsets[o], piece.hash(s, s + LENGTH)


def ranked(records: Records) -> tuple[Records, np.ndarray, np.ndarray]:
    """Multikey sort: by key, then only runs of equal keys by context, then by document.

    Returns the sorted records, where runs of one key start and where runs of one (key, context) start.
    """
    key, context, doc, _, _ = records
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    tied = np.flatnonzero(same[:-1] | same[1:])
    part = order[tied]
    order[tied] = part[np.lexsort((doc[part], context[part], ordered[tied]))]
    sorted_ = tuple(x[order] for x in records)
    key, context = sorted_[0], sorted_[1]
    run = np.ones(len(key), bool)
    run[1:] = key[1:] != key[:-1]
    group = run.copy()
    group[1:] |= context[1:] != context[:-1]
    return sorted_, run, group


def least_doc(doc: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For records in (key, context, document) order: the smallest document of each one's group."""
    return doc[np.maximum.accumulate(np.where(group, np.arange(len(doc)), 0))]


class Splitters:
    """Borders of the suffix order, from a bounded sample; a hot key is split between its contexts."""

    def __init__(self, key: np.ndarray, context: np.ndarray, buckets: int):
        order = np.lexsort((context, key))
        at = order[(np.arange(1, buckets) * len(key)) // buckets] if len(key) else order
        self.key, self.context = key[at], context[at]

    def bucket(self, key: np.ndarray, context: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.key, key, "left")
        for i in np.flatnonzero(self.cut(key)):
            lo, hi = np.searchsorted(self.key, key[i], "left"), np.searchsorted(self.key, key[i], "right")
            out[i] = lo + np.searchsorted(self.context[lo:hi], context[i], "right")
        return out

    def cut(self, key: np.ndarray) -> np.ndarray:
        """Keys whose records may lie on both sides of a border."""
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        return self.key[at] == key if len(self.key) else np.zeros(len(key), bool)


SENT = "bucket int, settled boolean, keys binary, contexts binary, docs binary, tags binary, places binary"
DTYPES = (U64, U64, np.int64, np.int32, np.uint32)


def send(records: Records, splitters: Splitters) -> Iterator[pa.RecordBatch]:
    """One row per bucket with packed records. Records that repeat a smaller document of this task are settled
    here and only pass through; so a hot string leaves a task once."""
    (key, context, doc, tag, pos), _, group = ranked(records)
    settled = doc > least_doc(doc, group)
    bucket = splitters.bucket(key, context)
    for done in (False, True):
        at = np.flatnonzero(settled == done)
        order = at[np.lexsort((pos[at], doc[at], bucket[at]))]
        borders = np.searchsorted(bucket[order], np.arange(len(splitters.key) + 2))
        for b, (lo, hi) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
            if lo < hi:
                rows = order[lo:hi]
                empty = b"" if done else None
                packed = [empty if done and i < 2 else x[rows].tobytes() for i, x in enumerate((key, context, doc, tag, pos))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([done]), *[pa.array([p], pa.binary()) for p in packed]],
                    names=["bucket", "settled", "keys", "contexts", "docs", "tags", "places"],
                )


def buffered(parts: Iterator[Records], splitters: Splitters) -> Iterator[pa.RecordBatch]:
    held: list[Records] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= BUFFER:
            yield from send(tuple(np.concatenate(x) for x in zip(*held, strict=True)), splitters)
            held, size = [], 0
    if size:
        yield from send(tuple(np.concatenate(x) for x in zip(*held, strict=True)), splitters)


FOUND = "doc long, tag int, place int, open boolean"


def found(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, is_open: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(tag.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(np.full(len(doc), is_open))],
        names=["doc", "tag", "place", "open"],
    )


def compare(splitters: Splitters, keep_open: bool):
    """For rows sorted by bucket: which records repeat a smaller document, and which stay open."""

    def settle(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        unpacked = [[np.frombuffer(r[c], t) for c, t in zip(("keys", "contexts", "docs", "tags", "places"), DTYPES, strict=True)] for r in rows]
        (key, _, doc, tag, pos), run, group = ranked(tuple(np.concatenate(x) for x in zip(*unpacked, strict=True)))
        least = least_doc(doc, group)
        repeat = doc > least
        yield found(doc[repeat], tag[repeat], pos[repeat], False)
        if keep_open:
            # Same lead, other context: these may still share a window. Runs that a border cuts count as such.
            starts = np.flatnonzero(run)
            number = np.cumsum(run) - 1
            several = (np.add.reduceat(group.astype(np.int64), starts) > 1) & (np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts))
            left = (several[number] | splitters.cut(key)) & ~repeat
            yield found(doc[left], tag[left], pos[left], True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # one bucket
        for batch in batches:
            for row in batch.to_pylist():
                if row["settled"]:
                    yield found(*[np.frombuffer(row[c], t) for c, t in zip(("docs", "tags", "places"), DTYPES[2:], strict=True)], False)
                    continue
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    return walk


def exchange(sent: DataFrame, splitters: Splitters, keep_open: bool, label: str) -> DataFrame:
    buckets = len(splitters.key) + 1
    placed = sent.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    return persist_to_shared(placed.mapInArrow(compare(splitters, keep_open), FOUND), label)


def sampled(rows: DataFrame, docs: int) -> tuple[Splitters, Splitters]:
    """Splitters for suffixes and for whole windows. Windows are hashed, so equal shares need no sample."""
    n = rows.count()

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, 2):
            data, offsets = arrays.texts(batch.column(2))
            parts = list(anchors(data, offsets)) or [(NONE[2], NONE[2], NONE[0], NONE[0])]
            key, context = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
            step = max(1, len(key) // (32 * batch.num_rows))  # some 32 to 64 suffixes a document
            yield pa.RecordBatch.from_arrays([pa.array(key[::step].view(np.int64)), pa.array(context[::step].view(np.int64)), pa.array(np.full(len(key[::step]), step))], names=["key", "context", "step"])

    picked = rows.sample(fraction=min(1.0, docs / max(n, 1)), seed=11).mapInArrow(sample, "key long, context long, step long").collect()
    key = np.array([r["key"] for r in picked], np.int64).view(U64)
    context = np.array([r["context"] for r in picked], np.int64).view(U64)
    anchors_ = sum(r["step"] for r in picked) * max(1.0, n / docs)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, int(anchors_ / BUCKET) + 1)
    even = (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(U64)
    windows = Splitters(NONE[0], NONE[1], 1)
    windows.key, windows.context = even, np.zeros(len(even), U64)
    return Splitters(key, context, buckets), windows


def identified(docs: DataFrame, key: str, text: str, carried: list[str] | None = None) -> DataFrame:
    """``(doc, tag, text)``: 32 bits of a text hash tell rows with one id and different texts apart."""
    tag = F.shiftright(F.xxhash64(whole(text)), 32).cast("int")
    row = [] if carried is None else [F.struct(*[F.col(f"`{c}`") for c in carried]).alias("__row")]
    return docs.select(*row, F.col(key).cast("long").alias("doc"), tag.alias("tag"), whole(text).alias("text"))


def with_places(rows: DataFrame, places: DataFrame, columns: list[Column], how: str) -> DataFrame:
    lists = places.groupBy(F.col("doc").alias("__doc"), F.col("tag").alias("__tag")).agg(*columns)
    return rows.join(lists, (F.col("doc") == F.col("__doc")) & (F.col("tag") == F.col("__tag")), how).drop("__doc", "__tag")


def repeated_places(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where ``(doc, tag, text)`` repeat smaller documents: anchors with their whole context, and single windows."""
    known = rows.where("doc is not null")
    suffixes, windows = sampled(known, SAMPLE_DOCS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in arrays.small(batches, 2):
                ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for doc, pos, key, context in anchors(*arrays.texts(batch.column(2))):
                    yield key, context, ids[doc].astype(np.int64), tags[doc].astype(np.int32), pos.astype(np.uint32)

        yield from buffered(parts(), suffixes)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in arrays.small(batches, 2):
                ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                lists = batch.column(3)
                pos = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                for owner, start, value in open_windows(*arrays.texts(batch.column(2)), doc, pos):
                    yield value, np.zeros(len(value), U64), ids[owner].astype(np.int64), tags[owner].astype(np.int32), start.astype(np.uint32)

        yield from buffered(parts(), windows)

    first = exchange(known.mapInArrow(scan, SENT), suffixes, True, "suffixes")
    unsure = with_places(known, first.where("open"), [F.collect_list("place").alias("places")], "inner")
    second = exchange(unsure.select("doc", "tag", "text", "places").mapInArrow(check, SENT), windows, False, "windows")
    return first.where("not open"), second


def mark(n: int, anchors_: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """True for each of n bytes that a repeat covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.concatenate([np.maximum(anchors_ - REACH, 0), windows]), 1)
    np.add.at(edge, np.concatenate([np.minimum(anchors_ + LENGTH, n), windows + LENGTH]), -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = True) -> DataFrame:
    """Put ``n_bytes, n_removed, n_spans, kept_sha256, kept`` in the place of the text, for every row of ``docs``.

    ``kept`` holds the bytes left (a cut can fall inside a character, so it is binary); it is null unless ``keep_bytes``.

    A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller id, judged on the
    input. Texts shorter than that, null and empty texts stay as they are. A row with a null id is neither
    cut nor a reason to cut; rows with one id never cut each other, and equal rows get equal results.
    """
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    carried = [c for c in replaced(docs, made).columns if c != text]
    rows = identified(docs, key, text)
    covered, single = repeated_places(rows)
    places = covered.select("doc", "tag", "place", F.lit(True).alias("wide")).union(single.select("doc", "tag", "place", F.lit(False).alias("wide")))
    lists = [F.collect_list(F.when(F.col("wide"), F.col("place"))).alias("__wide"), F.collect_list(F.when(~F.col("wide"), F.col("place"))).alias("__single")]
    joined = with_places(identified(docs, key, text, carried), places, lists, "left").select("__row", "text", "__wide", "__single")
    schema = joined.select("__row").schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "binary")):
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, 1):
            data, offsets = arrays.texts(batch.column(1))
            places = []
            for c in (2, 3):
                lists = batch.column(c)
                size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                places.append((lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(size)])))
            numbers, digests, kept = [], [], []
            for r in range(batch.num_rows):
                own = data[offsets[r] : offsets[r + 1]]
                wide, single = (flat[at[r] : at[r + 1]] for flat, at in places)
                if len(wide) + len(single):
                    gone = mark(len(own), wide, single)
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    left = own[~gone].tobytes()
                else:
                    spans, left = 0, own.tobytes()
                numbers.append((len(own), len(own) - len(left), spans))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if keep_bytes else None)
            columns = [pa.array([x[i] for x in numbers], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=["__row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(cut, schema).select("__row.*", *made)
