"""Quality rules as a short-circuit cascade, ordered by rejection per cost as measured on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.shared import replaced

SAMPLE_ROWS = 2000  # bound of the sample that orders the rules; it never decides a verdict

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


@cache
def letters() -> np.ndarray:
    """Which code points are letters, for any 21-bit number; made once per process."""
    return np.array([chr(c).isalpha() for c in range(0x110000)] + [False] * 0xF0000)


class Batch:
    """Measures of the documents of one Arrow batch; each is computed when a rule first asks for it."""

    table = arrays.byte_table(arrays.SPACES)
    lines_table = arrays.byte_table(b"\n")

    def __init__(self, column: pa.Array):
        self.column = column
        self.data, self.offsets = arrays.texts(column)
        self.n = len(column)

    def only(self, rows: np.ndarray) -> Batch:
        return Batch(self.column.take(pa.array(rows)))

    @cached_property
    def words(self):
        return arrays.words(self.data, self.offsets, self.table)

    @cached_property
    def n_words(self):
        return np.bincount(self.words[3], minlength=self.n)

    @cached_property
    def word_chars(self):
        lead = (self.data & 0xC0) != 0x80
        return arrays.sums(lead & (self.table[self.data] != 0), self.offsets)

    def _share(self, wanted: bytes):
        flags = np.zeros(256, bool)
        flags[list(wanted)] = True
        return arrays.sums(flags[self.data], self.offsets)

    @cached_property
    def n_symbols(self):
        return self._share(SYMBOLS)

    @cached_property
    def upper(self):
        return self._share(bytes(range(65, 91)))

    @cached_property
    def lower(self):
        return self._share(bytes(range(97, 123)))

    @cached_property
    def other_letters(self):
        """Letters beyond ASCII, of any script and case."""
        at = np.flatnonzero(self.data >= 0xC0)
        if not len(at):
            return np.zeros(self.n, np.int64)
        ahead = np.concatenate([self.data, np.zeros(3, np.uint8)])
        lead, a, b, c = (ahead[at + k].astype(np.int32) & (0xFF if k == 0 else 0x3F) for k in range(4))
        code = np.where(lead < 0xE0, (lead & 0x1F) << 6 | a, np.where(
            lead < 0xF0, (lead & 0xF) << 12 | a << 6 | b, (lead & 7) << 18 | a << 12 | b << 6 | c))
        flags = np.zeros(len(self.data), bool)
        flags[at] = letters()[code]
        return arrays.sums(flags, self.offsets)

    @cached_property
    def lines(self):
        """(lines with a word, lines equal to an earlier one) per document."""
        start, end, value, owner = arrays.words(self.data, self.offsets, self.lines_table)
        word = self.words[0]
        filled = np.searchsorted(word, end) > np.searchsorted(word, start)
        value, owner = value[filled], owner[filled]
        later = arrays.repeated(value, arrays.spans(owner, self.n))[1]
        return np.bincount(owner, minlength=self.n), np.bincount(owner[later], minlength=self.n)

    @cached_property
    def n_repeat_words(self):
        _, _, value, owner = self.words
        at, window = arrays.windows(value, owner, 3)
        twice = at[arrays.repeated(window, arrays.spans(owner[at], self.n))[0]]
        covered = np.zeros(len(value), bool)
        for k in range(3):
            covered[twice + k] = True
        return np.bincount(owner[covered], minlength=self.n)


Rule = Callable[[Batch], np.ndarray]

# Own rules: which documents each rejects. The first two are the base rules of the contract.
RULES: dict[str, Rule] = {
    "few_words": lambda b: b.n_words < 50,
    "repeated_words": lambda b: 100 * b.n_repeat_words > 50 * b.n_words,
    "symbols": lambda b: 10 * b.n_symbols > 3 * b.n_words,
    "repeated_lines": lambda b: 2 * b.lines[1] > b.lines[0],
    "shouting": lambda b: b.upper > b.lower + b.other_letters,
    "long_words": lambda b: b.word_chars > 25 * b.n_words,
}
BASE_RULES = ("few_words", "repeated_words")


def measured(docs: DataFrame, rules: dict[str, Rule], text: str, rows: int) -> list[str]:
    """Rule names by rejected documents per second of work, best first, as seen on at most about ``rows`` rows."""
    n = docs.count()
    if not n:
        return list(rules)

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, 0):
            for name, rule in rules.items():
                fresh = Batch(batch.column(0))
                begin = time.perf_counter()
                rejected = int(rule(fresh).sum())
                took = time.perf_counter() - begin
                yield pa.RecordBatch.from_pydict({"rule": [name], "rejected": [rejected], "seconds": [took]})

    sample = docs.select(text).sample(fraction=min(1.0, rows / n), seed=7)
    seen = sample.mapInArrow(trial, "rule string, rejected long, seconds double").groupBy("rule").agg(
        (F.sum("rejected") / (F.sum("seconds") + 1e-6)).alias("gain")
    )
    gain = {r["rule"]: r["gain"] for r in seen.collect()}  # one row per rule
    return sorted(rules, key=lambda r: -gain.get(r, 0.0))


def cascade(batch: Batch, alive: np.ndarray, order: list[str], rules: dict[str, Rule]) -> np.ndarray:
    """Rows that pass every rule; a rule only sees rows that all before it let through."""
    rows, current = np.flatnonzero(alive), batch
    if len(rows) < batch.n:
        current = batch.only(rows)
    for name in order:
        if not len(rows):
            break
        passed = ~rules[name](current)
        if not passed.all():
            rows = rows[passed]
            current = current.only(np.flatnonzero(passed))
    kept = np.zeros(batch.n, bool)
    kept[rows] = True
    return kept


def keep_good(docs: DataFrame, text: str = "text", rules: dict[str, Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that no rule rejects. A null or empty text has too few words; repeated rows share their fate."""
    rules = RULES if rules is None else rules
    order = measured(docs, rules, text, sample_rows)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, at):
            own = Batch(batch.column(at))
            yield batch.filter(pa.array(cascade(own, np.ones(own.n, bool), order, rules)))

    return docs.mapInArrow(keep, docs.schema)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, text: str = "text", rules: dict[str, Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Replace ``text`` by its measures, ``base_failed`` and ``kept``, for every row of ``docs``.

    ``kept`` is false where a base rule fails, else what the cascade of the other rules says. Null and empty
    texts have all measures 0 and fail; repeated rows get equal results.
    """
    rules = RULES if rules is None else rules
    made = [*MEASURES, "base_failed", "kept"]
    carried = [c for c in replaced(docs, made).columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text).alias("__text"))
    order = [r for r in measured(rows, rules, "__text", sample_rows) if r not in BASE_RULES]
    schema = rows.select(*carried).schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches, len(carried)):
            own = Batch(batch.column(len(carried)))
            numbers = [own.n_words, own.word_chars, own.n_symbols, own.lines[1], own.n_repeat_words]
            failed = np.zeros(own.n, bool)
            for name in BASE_RULES:
                failed |= RULES[name](own)
            kept = cascade(own, ~failed, order, rules)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carried)], *[pa.array(x, pa.int64()) for x in numbers], pa.array(failed), pa.array(kept)],
                names=[*carried, *made],
            )

    return rows.mapInArrow(measure, schema)
