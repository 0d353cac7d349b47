"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tablewright.llm import arrays
from tablewright.llm.arrays import U64
from tablewright.llm.shared import replaced, whole
from tablewright.session import persist_to_shared

TRAIN_ROWS = 24_000  # bound of the labelled sample the model is fitted on
BITS = 20  # hashed terms: words and the letter runs below
RUNS = (4, 5)
TERMS = 4096  # most terms the model keeps, by how much they tell
LEAST_DOCS, LEAST_CHI2 = 5, 25.0
FACTORS, EPOCHS, STEP, DECAY = 8, 12, 0.02, 1e-4
BATCH, LEAST_STEPS = 512, 600  # a small sample is gone through more often
THRESHOLD = 0.7

# ASCII letters and digits in lower case and all bytes of other scripts make words.
TABLE = arrays.byte_table(bytes(b for b in range(128) if not chr(b).isalnum()), lower=True)


def terms(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashed term, document) for all words and all runs of letters inside words, with repetitions."""
    data, offsets = arrays.texts(column)
    _, _, value, owner = arrays.words(data, offsets, TABLE)
    yield (value >> U64(64 - BITS)).astype(np.int64), owner
    for n in RUNS:
        if len(data) < n:
            continue
        ends = offsets[1:-1]
        for lo in range(0, len(data) - n + 1, arrays.PIECE):
            part = TABLE[data[lo : lo + arrays.PIECE + n - 1]].astype(U64)
            size = len(part) - n + 1
            key, good = np.zeros(size, U64), np.ones(size, bool)
            for k in range(n):
                at = part[k : k + size]
                key = (key << U64(9)) | at
                good &= at != 0
            near = ends[(ends > lo) & (ends < lo + size + n - 1)] - lo
            for k in range(1, n):  # runs that would cross from one document into the next
                cross = near - k
                good[cross[(cross >= 0) & (cross < size)]] = False
            at = np.flatnonzero(good)
            hashed = arrays.mixed(key[at] * U64(arrays.BASE) + U64(n)) >> U64(64 - BITS)
            yield hashed.astype(np.int64), np.searchsorted(offsets, at + lo, "right") - 1


def distinct(column: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(term, document) once each; ``chosen`` maps hashed terms to the model's terms, -1 for others."""
    found = []
    for term, owner in terms(column):
        if chosen is not None:
            term = chosen[term]
            keep = term >= 0
            term, owner = term[keep].astype(np.int64), owner[keep]
        found.append((owner << BITS) | term)
    both = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]))
    return both & ((1 << BITS) - 1), both >> BITS


@dataclass
class Model:
    chosen: np.ndarray  # hashed term to column, -1 for terms the model ignores
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def logit(self, term: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """bias + sum of weights + all pairwise interactions, in linear time."""
        out = self.bias + np.bincount(owner, self.weight[term], rows)
        for k in range(self.factor.shape[1]):
            v = self.factor[term, k]
            out += 0.5 * (np.bincount(owner, v, rows) ** 2 - np.bincount(owner, v * v, rows))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        term, owner = distinct(column, self.chosen)
        return 1 / (1 + np.exp(-np.clip(self.logit(term, owner, len(column)), -30, 30)))


def learn(term: np.ndarray, owner: np.ndarray, label: np.ndarray, n_terms: int, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss over mini-batches of the sample; returns bias, weights and factors."""
    rng = np.random.default_rng(seed)
    rows = len(label)
    theta = np.concatenate([np.zeros((n_terms, 1)), rng.normal(0, 0.02, (n_terms, FACTORS))], axis=1)
    rate = min(max(label.mean(), 1e-3), 1 - 1e-3) if rows else 0.5
    bias = float(np.log(rate / (1 - rate)))
    m, s, mb, sb, step = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0
    borders = np.searchsorted(owner, np.arange(rows + 1))
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(rows, 1)) if rows else 0)):
        shuffled = rng.permutation(rows)
        for lo in range(0, rows, BATCH):
            pick = shuffled[lo : lo + BATCH]
            size = borders[pick + 1] - borders[pick]
            at = np.repeat(borders[pick] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            t, r = term[at], np.repeat(np.arange(len(pick)), size)
            v = theta[t]
            total = np.stack([np.bincount(r, v[:, k], len(pick)) for k in range(1 + FACTORS)], axis=1)
            square = np.bincount(r, (v[:, 1:] ** 2).sum(axis=1), len(pick))
            logit = bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[pick]) / len(pick)
            grad = np.empty_like(theta)
            grad[:, 0] = np.bincount(t, error[r], n_terms)
            for k in range(1, 1 + FACTORS):
                grad[:, k] = np.bincount(t, error[r] * (total[r, k] - v[:, k]), n_terms)
            grad += DECAY * theta
            step += 1
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
            theta -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            mb, sb = 0.9 * mb + 0.1 * error.sum(), 0.999 * sb + 0.001 * error.sum() ** 2
            bias -= STEP * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.999**step)) + 1e-8)
    return bias, theta[:, 0].copy(), theta[:, 1:].copy()


def best_cut(logit: np.ndarray, label: np.ndarray) -> float:
    """The logit above which calling rows toxic gives the best F1 on the sample, half way to the next row."""
    order = np.argsort(-logit, kind="stable")
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(label) + 1) + label.sum())
    last = np.append(logit[order][1:] != logit[order][:-1], True)
    at = int(np.argmax(np.where(last, f1, -1)))
    below = logit[order][at + 1] if at + 1 < len(label) else logit[order][at] - 1
    return float((logit[order][at] + below) / 2)


def fit(sample: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """Fit on a bounded sample of ``(text, label)``. Terms are counted on the executors; the driver gets one row
    of counts per block of the hash space and then only the chosen terms of the sampled documents."""
    rows = sample.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.uint32)
        for batch in arrays.small(batches, 0):
            y = batch.column(1).to_numpy(zero_copy_only=False)
            term, owner = distinct(batch.column(0))
            for c in (0, 1):
                seen[c] += np.bincount(term[y[owner] == c], minlength=1 << BITS).astype(np.uint32)
        at = np.flatnonzero(seen.sum(axis=0))
        for lo in range(0, len(at), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(seen[c][part].astype(np.int64)) for c in (0, 1)]], names=["term", "n0", "n1"])

    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    empty = Model(np.full(1 << BITS, -1, np.int16), -30.0 if not n1 else 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    if not n0 or not n1:
        return empty
    df = rows.mapInArrow(count, "term long, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    share = (F.col("a") + F.col("b")) / (n0 + n1)
    chi2 = (F.col("b") - share * n1) ** 2 / (share * n1 * (1 - share) * n0 / (n0 + n1) + 1e-9)
    best = df.where((F.col("a") + F.col("b") >= LEAST_DOCS) & (share < 1)).select("term", chi2.alias("chi2")).where(F.col("chi2") >= LEAST_CHI2)
    picked = [r["term"] for r in best.orderBy(F.desc("chi2"), "term").limit(TERMS).collect()]  # at most TERMS rows
    chosen = np.full(1 << BITS, -1, np.int16)
    chosen[picked] = np.arange(len(picked))

    def only_chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, 0):
            term, owner = distinct(batch.column(0), chosen)
            borders = arrays.spans(owner, batch.num_rows)
            packed = [term[lo:hi].astype(np.int16).tobytes() for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], names=["terms", "label"])

    got = rows.mapInArrow(only_chosen, "terms binary, label int").collect()  # at most TRAIN_ROWS rows
    got.sort(key=lambda r: (r["label"], bytes(r["terms"])))
    lists = [np.frombuffer(r["terms"], np.int16).astype(np.int64) for r in got]
    label_ = np.array([r["label"] for r in got], float)
    term = np.concatenate([*lists, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    bias, weight, factor = learn(term, owner, label_, len(picked))
    model = Model(chosen, bias, weight, factor)
    cut = best_cut(model.logit(term, owner, len(lists)), label_)
    model.bias += float(np.log(THRESHOLD / (1 - THRESHOLD))) - cut  # so that the threshold stands at the best cut
    return model


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """At most ``rows`` labelled documents that are not held out, picked by a hash of the id; one text of each id."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
    picked = known.select(F.col(key).alias("__key"), F.col(label).alias("label")).distinct().orderBy(F.xxhash64("__key"), "__key", "label").limit(rows)
    small = F.broadcast(persist_to_shared(picked, "labels"))  # at most ``rows`` pairs of numbers
    found = docs.select(F.col(key).alias("__k"), whole(text).alias("text")).join(small, F.col("__k") == F.col("__key"))
    # An id may hold a large share of all rows: its texts meet as a minimum, task by task.
    return persist_to_shared(found.groupBy("__key", "label").agg(F.min("text").alias("text")).select("text", "label"), "sample")


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """Add ``held_out, score, predicted`` to every row of ``docs``.

    Only the text is an input of a score. Null and empty texts get the score of a text without any known term,
    repeated rows get equal scores; a null key counts as not held out. Without labels of both kinds nothing
    can be learned: every score is then near 0.
    """
    model = fit(training_rows(docs, labels, rows, key, text, label), "text", "label")
    made = ["held_out", "score", "predicted"]
    kept = replaced(docs, made).columns
    rows_ = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"))
    at = kept.index(text)
    schema = StructType([*rows_.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    # The model is small and of fixed size: a map of the hash space and at most TERMS rows of weights.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, at):
            value = shared.value.score(batch.column(at))
            columns = [pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "score", "predicted"])

    return rows_.mapInArrow(score, schema)
