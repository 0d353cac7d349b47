"""Near-duplicate documents: an exact Jaccard join on word shingles with rare-first prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays, graph
from tablewright.llm.arrays import U64
from tablewright.llm.shared import whole
from tablewright.session import discard, persist_to_shared

WORDS = 5  # words per shingle
PERCENT = 80  # least similarity, as a percentage
SKETCH_BITS = 20  # the frequency sketch has 2**20 counters whatever the size of the corpus
BLOCK = 1 << 12  # counters per row of the sketch
FILTER_BITS = 26  # size of the bitmap of ids that verification asks for: 8 MB
PARTS = 256  # partitions of the shingle space for the suffix filter
WAVES = 4  # the index is dealt by shingle in so many steps, so that only a part of it is on the move at one time
MANY = 255  # shingles in one part from which on their number is not told

TABLE = arrays.byte_table(arrays.SPACES, lower=True)


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents, n + 1 borders); too few words make one shingle."""
    data, offsets = arrays.texts(column)
    _, _, value, owner = arrays.words(data, offsets, TABLE)
    rows = len(column)
    at, hashes = arrays.windows(value, owner, n)
    owners = owner[at]
    counts = np.bincount(owner, minlength=rows)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = arrays.spans(owner, rows)
        own = [arrays.windows(value[first[r] : first[r + 1]], owner[first[r] : first[r + 1]], int(counts[r]))[1] + U64(counts[r]) for r in short]
        hashes, owners = np.concatenate([hashes, *own]), np.concatenate([owners, short])
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
    borders = arrays.spans(owners, rows)
    hashes = hashes.copy()
    for lo, hi in zip(borders[:-1], borders[1:], strict=True):
        hashes[lo:hi].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], arrays.spans(owners[new], rows)


def counter(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """How often each counter of a fixed-size sketch is hit by the shingles of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in arrays.small(batches, 1):
            np.add.at(total, counter(shingle_sets(batch.column(1), words)[0]), np.uint32(1))
        for b in range(0, len(total), BLOCK):
            if total[b : b + BLOCK].any():
                yield pa.RecordBatch.from_pydict({"block": [b // BLOCK], "counts": [total[b : b + BLOCK].tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most all blocks of the sketch
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        for block, counts in sums.items():
            yield pa.RecordBatch.from_pydict({"block": [block], "counts": [np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes()]})

    schema = "block long, counts binary"
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in persist_to_shared(docs.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema), "sketch").collect():  # 4 MB, always
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.uint32)
    return out


def id_bits(ids: np.ndarray) -> np.ndarray:
    return (arrays.mixed(ids.astype(np.int64).view(U64)) >> U64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds the hashes of all ids: it may let others pass, but loses none."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            at = id_bits(batch.column(0).to_numpy(zero_copy_only=False))
            np.bitwise_or.at(seen, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for b in range(0, len(seen), BLOCK):
            if seen[b : b + BLOCK].any():
                yield pa.RecordBatch.from_pydict({"block": [b // BLOCK], "bits": [seen[b : b + BLOCK].tobytes()]})

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}  # at most all blocks of the bitmap
        for batch in batches:
            for block, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks[block] = blocks.get(block, 0) | np.frombuffer(bits, np.uint8)
        for block, bits in blocks.items():
            yield pa.RecordBatch.from_pydict({"block": [block], "bits": [bits.tobytes()]})

    schema = "block long, bits binary"
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in persist_to_shared(ids.mapInArrow(mark, schema).repartition("block").mapInArrow(unite, schema), "bitmap").collect():  # 8 MB at most
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["bits"], np.uint8)
    return out


def needed(a: Column, b: Column, percent: int) -> Column:
    """Least size of the common set of two sets of these sizes, times 100 + percent."""
    return (a + b) * percent


def prefix_index(docs: DataFrame, counts, words: int, percent: int) -> DataFrame:
    """Rows ``(h, doc, n, pos)``: the rarest shingles of each set, as many as a similar set cannot miss all of.

    There is also one row per document with a null ``h``: ``n`` is its set's size and ``same_as`` the first document
    of the same task with an equal set. Only that first one is indexed, so a hot text leaves a task once.
    """
    rarity = docs.sparkSession.sparkContext.broadcast(counts)  # 2**SKETCH_BITS counters

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}  # 16 bytes per distinct set of this task's part of the input
        for batch in arrays.small(batches, 1):
            hashes, borders = shingle_sets(batch.column(1), words)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = np.diff(borders)
            common = rarity.value[counter(hashes)]
            lead, lead_of, lead_pos, first = [], [], [], []
            for row, (lo, hi) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
                if lo == hi:
                    first.append(None)
                    continue
                own = hashes[lo:hi]
                name = arrays.mixed(own ^ U64(0x5BD1E995)).sum().tobytes() + arrays.mixed(own + U64(0x27D4EB2F)).sum().tobytes()
                known = seen.setdefault(name, int(ids[row]))
                first.append(known)
                if known == ids[row]:
                    n = hi - lo
                    take = n - (n * percent + 99) // 100 + 1
                    order = np.lexsort((own, common[lo:hi]))[:take]
                    lead.append(own[order])
                    lead_of.append(np.full(take, row))
                    lead_pos.append(np.arange(take))
            of = np.concatenate([*lead_of, np.zeros(0, np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(np.concatenate([*lead, np.zeros(0, U64)]).view(np.int64)), pa.nulls(len(ids), pa.int64())]),
                pa.array(np.concatenate([ids[of], ids])),
                pa.array(np.concatenate([sizes[of], sizes]).astype(np.int32)),
                pa.array(np.concatenate([*lead_pos, np.zeros(len(ids), np.int64)]).astype(np.int32)),
                pa.concat_arrays([pa.nulls(len(of), pa.int64()), pa.array(first, pa.int64())]),
            ], names=["h", "doc", "n", "pos", "same_as"])

    return docs.mapInArrow(index, "h long, doc long, n int, pos int, same_as long")


def shared_prefixes(index: DataFrame, percent: int) -> DataFrame:
    """Entries of shingles that several documents have: ``(h, doc, n, pos, star, star_n, star_pos)``.

    Each task walks its sorted part batch by batch. ``star`` is, of the sets that the length filter lets meet this
    one, that with the fewest rarer shingles: the text a group of near copies comes from has none of its own, so
    most of the group links to it. Entries alone with their shingle link nothing and go.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "doc", "n", "pos"]
        last: list[np.ndarray] | None = None  # last entry so far, not yet given out if alone
        star: tuple[int, int, int, int] | None = None
        pending = False
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if last is not None and pending:
                cols = [np.concatenate([x, y]) for x, y in zip(last, cols, strict=True)]
            elif last is not None and len(cols[0]) and cols[0][0] == last[0][0]:
                pass  # goes on with the run whose star is known
            if not len(cols[0]):
                continue
            h, doc, n, pos = cols
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            carried = star is not None and not pending and h[0] == star[0]
            new[0] = not carried
            alone = new & np.append(new[1:], True)
            start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            sd, sn, sp = doc[start], n[start].astype(np.int64), pos[start]
            if carried:
                run = np.cumsum(new) == 0
                sd, sn, sp = np.where(run, star[1], sd), np.where(run, star[2], sn), np.where(run, star[3], sp)
            while True:  # sets too long or short for their star get the first such set of the run as star
                own = n.astype(np.int64)
                far = (100 * sn < percent * own) | (100 * own < percent * sn)
                if not far.any():
                    break
                run_no = np.cumsum(new)
                at = np.flatnonzero(far)
                head = np.searchsorted(run_no[at], run_no[at])
                sd[at], sn[at], sp[at] = doc[at[head]], n[at[head]], pos[at[head]]
            pending = bool(alone[-1])
            last = [c[-1:].copy() for c in cols]
            star = (int(h[-1]), int(sd[-1]), int(sn[-1]), int(sp[-1]))
            give = ~alone
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[give]) for c in cols] + [pa.array(sd[give]), pa.array(sn[give].astype(np.int32)), pa.array(sp[give].astype(np.int32))],
                names=[*names, "star", "star_n", "star_pos"],
            )

    schema = "h long, doc long, n int, pos int, star long, star_n int, star_pos int"
    placed = index.where("h is not null").select("h", "doc", "n", "pos").repartition("h").sortWithinPartitions("h", "pos", "n", "doc")
    return placed.mapInArrow(walk, schema)


def possible(n: Column, pos: Column, m: Column, at: Column, percent: int) -> Column:
    """Length and positional filters: two sets whose first shared shingle stands at these places can still be similar.

    Both orders are the same, so nothing before the first shared shingle is shared. Later ones may fail: a similar
    pair needs the row of its first one only.
    """
    most = F.least(n - pos, m - at)
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (most * (100 + percent) >= needed(n, m, percent))


def part_sizes(hashes: np.ndarray) -> bytes:
    """How many shingles of a set each of ``PARTS`` parts of the shingle space has."""
    return np.minimum(np.bincount((hashes & U64(PARTS - 1)).astype(np.int64), minlength=PARTS), MANY).astype(np.uint8).tobytes()


def among(docs: DataFrame, ids: DataFrame, words: int, name: str, give) -> DataFrame:
    """``(id, <name>)``: what ``give`` makes of the shingle sets of the documents whose ids are listed, and of a few others.

    Texts stay where they are: a bitmap of the wanted ids travels to them. Those it lets pass by chance meet no pair.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, 1):
            at = id_bits(batch.column(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array((wanted.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            if not batch.num_rows:
                continue
            hashes, borders = shingle_sets(batch.column(1), words)
            made = [give(hashes[lo:hi]) for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["id", name])

    return docs.mapInArrow(sets, f"id long, {name} binary")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that are similar enough; every pair is compared once, on whole sets.

    Before whole sets travel, a suffix filter compares how many shingles the two sets have in each of ``PARTS``
    parts of the shingle space: they cannot share more than the smaller number of each part. Whole sets are as large as
    the texts they come from, so they are made anew for each side of the pairs left and go to the exchange unwritten.
    """

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int32) for i in (2, 3))
            most = np.minimum(x, y).sum(axis=1)
            fits = most * (100 + percent) >= (x.sum(axis=1) + y.sum(axis=1)) * percent
            fits |= ((x == MANY) | (y == MANY)).any(axis=1)  # numbers unknown: no bound
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")
                both = int((merged[1:] == merged[:-1]).sum())
                similar.append(100 * both >= percent * (len(merged) - both))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    def joined(pairs: DataFrame, one: DataFrame, other: DataFrame, then) -> DataFrame:
        one, other = (df.toDF(f"__{s}", s) for df, s in ((one, "x"), (other, "y")))
        return pairs.join(one, F.col("a") == F.col("__x")).join(other, F.col("b") == F.col("__y")).select("a", "b", "x", "y").mapInArrow(then, "a long, b long")

    parts = persist_to_shared(among(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), words, "parts", part_sizes), "parts")
    left = persist_to_shared(joined(pairs, parts, parts, may), "pairs")
    discard(parts)
    one, other = (among(docs, left.select(s), words, "shingles", np.ndarray.tobytes) for s in ("a", "b"))
    links = persist_to_shared(joined(left, one, other, compare), "links")
    discard(left)
    return links


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, n_shingles, component)`` per document; the component is the smallest id reachable by links.

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets. Documents without
    words have no shingles and link with nothing. A row with a null id is left out, as nothing can name it;
    rows with one id must agree on the text (their sets are linked as one node otherwise). No link between
    different texts is lost and no group is expanded into all its pairs:

    1. Prefixes of the rarest shingles are sorted by shingle; each entry is paired with its star only.
    2. Verified stars give first components. Only shingles that still hold several components are joined
       again, and only between entries of different components.
    """
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), whole(text).alias("text"))
    index = persist_to_shared(prefix_index(rows, frequencies(rows, words), words, percent), "index")
    same = persist_to_shared(index.where("h is null").select("doc", "n", "same_as"), "sizes")
    waves = [persist_to_shared(shared_prefixes(index.where(F.pmod("h", F.lit(WAVES)) == w), percent), "hits") for w in range(WAVES)]
    hits = reduce(DataFrame.unionByName, waves)
    discard(index)
    star = hits.where((F.col("star") != F.col("doc")) & possible(F.col("n"), F.col("pos"), F.col("star_n"), F.col("star_pos"), percent))
    pairs = persist_to_shared(star.select(F.col("star").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
    links = verified(pairs, rows, words, percent)
    copies = same.where("same_as is not null and same_as != doc").select(F.col("same_as").alias("a"), F.col("doc").alias("b"))
    first = graph.components(links)

    # What the stars leave open: shingles with more than one component.
    root = first.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    named = hits.join(root, F.col("doc") == F.col("__n"), "left").select("h", "doc", "n", "pos", F.coalesce("__r", "doc").alias("c"))
    named = persist_to_shared(named, "named")
    discard(*waves)
    per = named.groupBy("h", "c").agg(F.count("*").alias("k")).groupBy("h").agg(F.max_by("c", "k").alias("main"), F.count("*").alias("cs"))
    open_ = named.join(per.where("cs > 1").select(F.col("h").alias("__h"), "main"), F.col("h") == F.col("__h")).drop("__h")
    open_ = persist_to_shared(open_, "open")
    discard(named)
    other = open_.select(F.col("h").alias("__h"), F.col("doc").alias("__d"), F.col("n").alias("__m"), F.col("pos").alias("__p"), F.col("c").alias("__c"))
    once = (F.col("__c") == F.col("main")) | (F.col("doc") < F.col("__d"))
    meet = open_.where("c != main").join(
        other, (F.col("h") == F.col("__h")) & (F.col("c") != F.col("__c")) & once & possible(F.col("n"), F.col("pos"), F.col("__m"), F.col("__p"), percent)
    ).select(
        F.least("doc", "__d").alias("a"), F.greatest("doc", "__d").alias("b"), (F.col("n") + F.col("__m")).alias("both"),
        F.when(F.col("doc") < F.col("__d"), F.col("n") - F.col("pos")).otherwise(F.col("__m") - F.col("__p")).alias("left_a"),
        F.when(F.col("doc") < F.col("__d"), F.col("__m") - F.col("__p")).otherwise(F.col("n") - F.col("pos")).alias("left_b"),
    )
    # Up to the last of these shingles exactly ``count`` are shared; what stands behind it may be.
    most = F.count("*") - 1 + F.least(F.min("left_a"), F.min("left_b"))
    meet = meet.groupBy("a", "b").agg((most * (100 + percent) >= F.max("both") * percent).alias("fits")).where("fits").select("a", "b")
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = persist_to_shared(meet.join(done, ["a", "b"], "left_anti"), "pairs")
    discard(open_)
    late = verified(more, rows, words, percent)
    found = graph.components(copies.union(links).union(late))
    found = found.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return same.join(found, F.col("doc") == F.col("__n"), "left").select(
        "doc", F.col("n").cast("long").alias("n_shingles"), F.coalesce("__r", "doc").alias("component")
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of similar ones: that with the smallest id. Rows with a null id stay."""
    groups = similar_documents(docs, words, percent, key, text)
    gone = groups.where("component != doc").select(F.col("doc").alias("__gone")).distinct()
    return docs.join(gone, F.col(key).cast("long") == F.col("__gone"), "left_anti")
