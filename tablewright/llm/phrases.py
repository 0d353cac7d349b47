"""Phrase collocation mining: Misra-Gries summaries per hash partition find what can be frequent, a second pass counts it.

The first pass hashes every run of one to ``longest`` words and deals the hashes to partitions. A partition that holds
``mass`` runs keeps a summary of more than ``mass / least`` counters, so no run found ``least`` times or more can be
missing from it. The second pass counts the survivors exactly, by their words and not by their hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.arrays import U64
from tablewright.llm.near_copies import id_bits, id_filter
from tablewright.llm.shared import SMALL, ranked_within
from tablewright.operators.skew import join_per_key
from tablewright.session import discard, persist_to_shared

LEAST = 10  # occurrences of a candidate
LONGEST = 3  # words of a candidate
COVER = 50  # per cent of a candidate's occurrences inside a longer one that make it redundant
TOP = 2000  # phrases reported per language
SCALE = 1_000_000
BATCH = 2 << 20  # bytes of text whose words are held at one time
BUFFER = 1 << 20  # words a task holds before it combines and sends their runs
BUCKET = 1 << 23  # runs per hash partition, about
KEY = 5  # bytes of a hash that are sent, besides the bits that name its partition

# What parts words, and what also parts pieces.
GAPS = b"\x20\x09"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
TABLE = arrays.byte_table(GAPS + BREAKS, lower=True)
BREAK = np.zeros(256, bool)
BREAK[list(BREAKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lang_salt(lang: str) -> int:
    """A number per language that keeps equal words of different languages apart."""
    raw = lang.encode()
    return (zlib.crc32(raw) << 32) | zlib.crc32(raw, 0xFFFF)


class Runs:
    """Words of a batch and their runs."""

    def __init__(self, langs: pa.Array, column: pa.Array):
        self.data, self.offsets = arrays.texts(column)
        self.start, self.end, self.value, self.owner = arrays.words(self.data, self.offsets, TABLE)
        breaks = np.flatnonzero(BREAK[self.data])
        # Documents and pieces ascend together, so their sum names a piece.
        self.piece = self.owner + np.searchsorted(breaks, self.start)
        coded = langs.dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.salt = np.array([lang_salt(x) for x in self.names] or [0], U64)

    def of(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words; only the bits that are sent are set in a hash."""
        at, value = arrays.windows(self.value, self.piece, n)
        spare = U64(key_shift(bits))
        return at, arrays.mixed(value + self.salt[self.lang[self.owner[at]]] + U64(n)) >> spare << spare

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        """The words of runs, joined by one space."""
        lo, hi = self.start[first], self.end[first + n - 1]
        plain = hi - lo == sum(self.end[first + k] - self.start[first + k] for k in range(n)) + n - 1
        for k in range(n - 1):
            plain &= self.data[self.end[first + k]] == 0x20
        size = (hi - lo)[plain]
        borders = np.concatenate([[0], np.cumsum(size)])
        raw = LOWER[self.data[np.repeat(lo[plain] - borders[:-1], size) + np.arange(borders[-1])]]
        cut = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(raw.tobytes())).cast(pa.string())
        if plain.all():
            return cut
        odd = [b" ".join(LOWER[self.data[self.start[f + k] : self.end[f + k]]].tobytes() for k in range(n)).decode() for f in first[~plain].tolist()]
        place = np.empty(len(first), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(first))
        return pa.concat_arrays([cut, pa.array(odd, pa.string())]).take(pa.array(place))


def batches_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
    for batch in arrays.small(batches, 1, BATCH):
        yield Runs(batch.column(0), batch.column(1))


# ---------------------------------------------------------------- first pass

SENT = "bucket int, part int, mass long, hashes binary, counts binary"


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


class Summary:
    """Misra-Gries: at most ``capacity`` counters. No count is short by more than ``lost``, and ``lost`` stays below
    the mass divided by the capacity, in whatever order summaries are merged."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.hashes, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def merge(self, hashes: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        self.waiting.append((hashes, counts))
        self.size += len(hashes)
        self.lost += lost
        if self.size > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        parts = [(self.hashes, self.counts), *self.waiting]
        self.hashes, self.counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        self.waiting, self.size = [], 0
        over = len(self.counts) - self.capacity
        if over > 0:
            # Take the (capacity + 1)-th largest count from all counters: each unit taken is matched by capacity others.
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            left = self.counts > cut
            self.hashes, self.counts, self.lost = self.hashes[left], self.counts[left] - cut, self.lost + cut

    def survivors(self, least: int) -> np.ndarray:
        """Hashes whose true count can be ``least`` or more."""
        self.settle()
        return self.hashes[self.counts + self.lost >= least]


def key_shift(bits: int) -> int:
    return max(0, 64 - bits - 8 * KEY)


def send(hashes: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket with its share of the combined runs, and one with their number. Empties ``hashes``."""
    every = np.concatenate(hashes)
    hashes.clear()
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    value, n = every[first], len(every)
    del every
    count = np.diff(first, append=n)
    del first
    # The bucket is the high part of the hash, so buckets are slices of the sorted hashes.
    borders = np.searchsorted(value, np.arange(1 << bits, dtype=U64) << U64(64 - bits)) if bits else np.zeros(1, np.int64)
    borders = np.append(borders, len(value))
    width = KEY if key_shift(bits) else 8
    for b in range(1 << bits):
        lo, hi = int(borders[b]), int(borders[b + 1])
        if lo < hi:
            low = (value[lo:hi] << U64(bits) >> U64(bits) >> U64(key_shift(bits))).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            often = np.flatnonzero(count[lo:hi] > 1)
            # Counts above one follow as (place, count) pairs: most runs of a buffer stand alone.
            pairs = np.stack([often, count[lo:hi][often]]).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b] * 2, pa.int32()), pa.array([0, 1], pa.int32()), pa.array([int(count[lo:hi].sum()), 0], pa.int64()),
                 pa.array([None, low.tobytes()], pa.binary()), pa.array([None, pairs.tobytes()], pa.binary())],
                names=["bucket", "part", "mass", "hashes", "counts"],
            )


def sent_runs(batches: Iterator[pa.RecordBatch], longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    """What a task sends: the hashes of about ``BUFFER`` words' runs are held, combined and given out."""
    held, size = [], 0
    for found in batches_of_words(batches):
        held += [found.of(n, bits)[1] for n in range(1, longest + 1)]
        size += len(found.value)
        if size >= BUFFER:
            yield from send(held, bits)
            size = 0
    if held:
        yield from send(held, bits)


def opened(bucket: int, hashes: pa.Buffer, counts: pa.Buffer, bits: int) -> tuple[np.ndarray, np.ndarray]:
    width = KEY if key_shift(bits) else 8
    sent = np.frombuffer(hashes, np.uint8).reshape(-1, width)
    wide = np.zeros((len(sent), 8), np.uint8)
    wide[:, :width] = sent
    value = (wide.reshape(-1).view("<u8") << U64(key_shift(bits))) | (U64(bucket) << U64(64 - bits) if bits else U64(0))
    count = np.ones(len(value), np.int64)
    at, more = np.frombuffer(counts, np.uint32).reshape(2, -1).astype(np.int64)
    count[at] = more
    return value, count


def bucket_bits(rows: DataFrame, runs: int) -> int:
    """There are 2 to this power hash partitions: as many as Spark's, and no more than ``BUCKET`` runs in one."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions - 1, runs // BUCKET).bit_length()


def can_be_frequent(rows: DataFrame, longest: int, least: int, bits: int) -> DataFrame:
    """Hashes of all runs of ``(lang, text)`` found ``least`` times or more, and of some that are not: ``(h)``."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket, the masses of a bucket before its summaries."""
        own, mass, summary = None, 0, None

        def ended() -> Iterator[pa.RecordBatch]:
            if summary is not None:
                yield pa.RecordBatch.from_arrays([pa.array(summary.survivors(least).view(np.int64))], names=["h"])

        for batch in batches:
            hashes, counts = batch.column(3), batch.column(4)  # read where they lie, a row at a time
            for i, (bucket, part, some) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                if bucket != own:
                    yield from ended()
                    own, mass, summary = bucket, 0, None
                if part == 0:
                    mass += some
                else:
                    summary = summary or Summary(mass // least + 1)
                    summary.merge(*opened(bucket, hashes[i].as_buffer(), counts[i].as_buffer(), bits))
        yield from ended()

    sent = rows.mapInArrow(lambda batches: sent_runs(batches, longest, bits), SENT)
    placed = sent.repartitionById(1 << bits, F.col("bucket")).sortWithinPartitions("bucket", "part")
    return persist_to_shared(placed.mapInArrow(reduce, "h long"), "survivors")


# ---------------------------------------------------------------- second pass


def exact_counts(rows: DataFrame, survivors: DataFrame, longest: int, least: int, bits: int) -> DataFrame:
    """``(lang, n_words, phrase, f)`` for every phrase found ``least`` times or more, counted by its words. A row with
    ``n_words`` 0 holds all words of the language.

    A bitmap of the survivors' hashes, of fixed size, travels to the texts. What it lets pass by chance is counted too
    and found to be rare.
    """
    wanted = rows.sparkSession.sparkContext.broadcast(id_filter(survivors))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches_of_words(batches):
            names = pa.array(found.names, pa.string())
            yield totals(names, np.bincount(found.lang[found.owner], minlength=len(names)))
            for n in range(1, longest + 1):
                first, value = found.of(n, bits)
                at = id_bits(value)
                pick = np.flatnonzero((wanted.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                _, where, count = np.unique(value[pick], return_index=True, return_counts=True)
                heads = first[pick][where]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(found.lang[found.owner[heads]])), pa.array(np.full(len(heads), n, np.int32)), found.phrases(heads, n), pa.array(count)],
                    names=["lang", "n_words", "phrase", "f"],
                )

    def totals(names: pa.Array, count: np.ndarray) -> pa.RecordBatch:
        zero, nothing = pa.array(np.zeros(len(names), np.int32)), pa.array([""] * len(names))
        return pa.RecordBatch.from_arrays([names, zero, nothing, pa.array(count.astype(np.int64))], names=["lang", "n_words", "phrase", "f"])

    some = rows.mapInArrow(scan, "lang string, n_words int, phrase string, f long")
    every = some.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("n_words") == 0))
    return persist_to_shared(every, "counts")


# ---------------------------------------------------------------- scores


def measured(df: DataFrame, *texts: str) -> int:
    """Bytes of a written table of short texts, about."""
    size = df.agg(F.sum(sum((F.octet_length(c) for c in texts), F.lit(64))).alias("b")).first()["b"]
    return size or 0


def with_count(cuts: DataFrame, counts: DataFrame, part: str, name: str, small: int) -> DataFrame:
    """Add how often each cut's ``part`` occurs. A common word is part of many candidates, so beyond ``small`` bytes of
    counts its rows travel under a salt."""
    known = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    if measured(counts, "lang", "phrase") <= small:
        return cuts.join(F.broadcast(known), ["lang", part])
    weights = cuts.groupBy("lang", part).agg(F.count("*").alias("__weight"))
    per_key = persist_to_shared(weights.join(known, ["lang", part]), "parts")
    return join_per_key(cuts, per_key, ["lang", part], "__weight", "phrase")


def scored(counts: DataFrame, longest: int, cover: int, small: int = SMALL) -> DataFrame:
    """``(lang, phrase, n_words, a, cut, l, r, score)`` of the candidates that no longer one makes redundant."""
    words = F.split("phrase", " ")
    join = lambda c, lo, size: F.array_join(F.slice(c, lo, size), " ")
    candidates = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"))
    inner = candidates.where("n_words > 2").select("lang", "n_words", F.col("a").alias("f"), words.alias("w"), F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
    inner = inner.select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy(F.col("lang").alias("__l"), join("w", F.col("at"), F.col("size")).alias("__p")).agg(F.max("f").alias("__f"))
    redundant = (F.col("lang") == F.col("__l")) & (F.col("phrase") == F.col("__p")) & (F.col("__f") * 100 >= F.col("a") * cover)
    kept = candidates.join(inner, redundant, "left_anti")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("cut"))
    cuts = cuts.select("*", join(words, F.lit(1), F.col("cut")).alias("first"), join(words, F.col("cut") + 1, F.col("n_words") - F.col("cut")).alias("rest"))
    cuts = persist_to_shared(cuts, "cuts")
    parts = counts.where((F.col("n_words") > 0) & (F.col("n_words") < longest))
    weighed = with_count(with_count(cuts, parts, "first", "l", small), parts, "rest", "r", small)
    # Exact in 38 digits: counts stay below 10^15, and a is at most l and r, so the quotient is at most SCALE.
    score = F.expr(f"cast(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(31,0)) * cast({SCALE} as decimal(7,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least = weighed.groupBy("lang", "phrase", "n_words", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m"))
    return least.select("lang", "phrase", "n_words", "a", "m.*")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
                 cover: int = COVER, top: int = TOP, small: int = SMALL) -> DataFrame:
    """``(lang, rank, phrase, n_words, a, cut, l, r, n, score)``: the best phrases of each language.

    A candidate is a phrase of 2 to ``longest`` words found ``a >= least`` times inside pieces of text. Cut in two
    where that gives the lowest score, its parts occur ``l`` and ``r`` times. Repeated rows count again; null and empty
    texts hold no words, so a language that has only such texts gives no rows; a null language is ``und``, with rows
    that say so. Within one batch of text equal 64-bit hashes are taken for equal phrases; across batches the words
    themselves are compared.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bucket_bits(rows, longest * size // 6)
    survivors = can_be_frequent(rows, longest, least, bits)
    counts = exact_counts(rows, survivors, longest, least, bits)
    discard(survivors)
    totals = counts.where("n_words = 0").select(F.col("lang").alias("__l"), F.col("f").alias("n"))
    best = persist_to_shared(scored(counts, longest, cover, small), "scored")
    ranked = ranked_within(best, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]).where(F.col("__rank") < top)
    return ranked.join(totals, F.col("lang") == F.col("__l")).select(
        "lang", (F.col("__rank") + 1).alias("rank"), "phrase", "n_words", "a", "cut", "l", "r", "n", "score"
    )
