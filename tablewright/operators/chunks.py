"""Documents cut into overlapping chunks."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_chunks(docs: DataFrame, key: str, text: str = "text", size: int = 1000, overlap: int = 100) -> DataFrame:
    """Windows of ``size`` characters that start every ``size - overlap`` characters, over the whole text.

    The last window is the first one that reaches the end. Empty texts give no chunk.
    """
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - size) / F.lit(step)), F.lit(0))
    cuts = F.when(F.length(text) > 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))
    return docs.select(key, text, F.explode(cuts).alias("chunk_no")).select(
        key, "chunk_no", F.substring(F.col(text), F.col("chunk_no").cast("int") * step + 1, F.lit(size)).alias("chunk")
    )


# Where to cut, best place first.
SEPARATORS = ["\n\n", "\n", " ", ""]


def _marks(text: str, size: int) -> np.ndarray:
    """Offsets where a chunk may begin or end: no two neighbours are further apart than ``size``.

    Gaps that are too wide are cut before every occurrence of the coarsest separator, what is still too wide
    before the next one, and at last every ``size`` characters.
    """
    marks = np.array([0, len(text)])
    for sep in SEPARATORS:
        wide = np.flatnonzero(np.diff(marks) > size)
        if not len(wide):
            break
        found = []
        for lo, hi in zip(marks[wide].tolist(), marks[wide + 1].tolist()):
            if sep:
                found += [lo + m.start() for m in re.finditer(re.escape(sep), text[lo:hi])]
            else:
                found += range(lo, hi, size)
        marks = np.union1d(marks, np.array(found, "int64"))
    return marks


def _spans(marks: np.ndarray, size: int, overlap: int) -> list[tuple[int, int]]:
    """Chunks as spans between marks, each as long as ``size`` allows.

    A chunk begins at the first mark that is at most ``overlap`` before the end of the last one and leaves room
    for one piece more than that.
    """
    ends = marks[np.searchsorted(marks, marks + size, "right") - 1]
    spans, begin = [], 0
    while True:
        spans.append((int(marks[begin]), int(ends[begin])))
        if ends[begin] == marks[-1]:
            return spans
        beyond = np.searchsorted(marks, ends[begin], "right")
        begin = int(np.searchsorted(marks, max(ends[begin] - overlap, marks[beyond] - size)))


def _cut(text: str, size: int, overlap: int) -> list[str]:
    spans = _spans(_marks(text, size), size, overlap) if text else []
    return [c for c in (text[lo:hi].strip() for lo, hi in spans) if c]


def separator_chunks(docs: DataFrame, key: str, text: str = "text", size: int = 1000, overlap: int = 100) -> DataFrame:
    """Chunks that prefer paragraph, line and word boundaries. Map-only; Spark splits the documents."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _cut(t or "", size, overlap))

    return docs.select(key, F.posexplode(cut(F.col(text))).alias("chunk_no", "chunk"))


def rechunk_changed(old: DataFrame, new: DataFrame, key: str, text: str = "text", **kw) -> DataFrame:
    """Chunks of new and changed documents only.

    Only hashes are compared; the keys that differ then select the texts, so a small change moves
    few keys and no text of an unchanged document.
    """
    a = old.select(key, F.sha2(F.col(text), 256).alias("_h"))
    changed = new.select(key, F.sha2(F.col(text), 256).alias("_h")).join(a, [key, "_h"], "left_anti").select(key)
    return fixed_chunks(new.join(changed, key, "left_semi"), key, text, **kw)
