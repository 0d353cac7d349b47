"""Pack tokenised documents into sequences of a fixed window: best-fit decreasing inside bounded shares of the pieces."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.llm import arrays
from tablewright.llm.shared import replaced
from tablewright.session import persist_to_shared

WINDOW = 2048
END = 1  # id that closes a document
SHARE = 8192  # tails that one best-fit run packs, about
# Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# ---------------------------------------------------------------- tokens


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(described: dict) -> dict[bytes, int] | None:
    """Token bytes to ids if the file describes plain byte-level merges whose ids stand in merge order, else None."""
    model, split = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        and not described.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    )
    if not plain:
        return None
    letters, vocabulary = byte_letters(), model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(c not in vocabulary for c in letters) or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    added = {t["content"] for t in described["added_tokens"]}
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in added}


@lru_cache(maxsize=4)
def encoder(path: str | None) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts to ids as ``tokenizers`` gives them for the file at ``path`` (None: the public byte-level one of 50k).

    Byte-level files are run by ``tiktoken`` over the same merges, several times faster with the same ids; texts that
    hold the string of an added token, and files of other kinds, go to ``tokenizers`` itself.
    """
    import tiktoken

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    ranks, added = merge_ranks(described), [t["content"] for t in described["added_tokens"]]
    fast = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    @lru_cache(maxsize=1)
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if fast is None or any(a in text for a in added):
                out.append(np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                out.append(fast.encode_to_numpy(text, disallowed_special=()))
        return out

    return encode


def pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise and cut: ``(<key>, start, length, ids, doc_tokens)``, ``ids`` as little-endian unsigned 32-bit numbers.

    Documents longer than the window are cut into full windows; what remains is the tail. Every row of ``docs`` is a
    document, closed by the id ``end``; a null text is an empty one and has that id alone. ``tokenizer`` is the path of a
    vocabulary file on every machine.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in arrays.small(batches, 1):
            rows, starts, lengths, ids, totals = [], [], [], [], []
            for row, found in enumerate(encode(batch.column(1).fill_null("").to_pylist())):
                found = np.append(found.astype("<u4"), np.array([end], "<u4"))
                for at in range(0, len(found), window):
                    part = found[at : at + window]
                    rows.append(row)
                    starts.append(at)
                    lengths.append(len(part))
                    ids.append(part.tobytes())
                    totals.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
                names=[key, "start", "length", "ids", "doc_tokens"],
            )

    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    schema = StructType([narrow.schema[0]]).add("start", "long").add("length", "long").add("ids", "binary").add("doc_tokens", "long")
    return narrow.mapInArrow(cut, schema)


# ---------------------------------------------------------------- best fit


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose leaves are the capacities and whose nodes say whether
    any window below is open. The tightest window for a length is the first open leaf from that length on."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.open = bytearray(2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.at[capacity].append(window)
        node = self.base + capacity
        while node and not self.open[node]:
            self.open[node] = 1
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of at least ``length``: (capacity, window)."""
        node = self.base + length
        while not self.open[node]:  # up, until a node to the right is open
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
        while node < self.base:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.base
        found = self.at[capacity].pop()
        if not self.at[capacity]:
            self.open[node] = 0
            node >>= 1
            while node and not (self.open[2 * node] or self.open[2 * node + 1]):
                self.open[node] = 0
                node >>= 1
        return capacity, found


class BestFit:
    """Windows of one share; lengths come in descending order."""

    def __init__(self, window: int):
        self.window, self.room, self.opened = window, OpenWindows(window), 0

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) of the next piece."""
        capacity, number = self.room.tightest(length) or (self.window, self.opened)
        self.opened += number == self.opened
        if capacity > length:
            self.room.add(capacity - length, number)
        return number, self.window - capacity


def pack(pieces: DataFrame, window: int = WINDOW, share: int = SHARE, length: str = "length") -> DataFrame:
    """Add ``sequence_id, offset`` to every piece: pieces of one sequence stand gapless from offset 0, at most ``window``.

    Pieces that fill a window are sequences of their own and do not move. The others are dealt into shares of about
    ``share`` pieces, evenly whatever their ids or texts are, and packed share by share, the longest first, each into
    the open window with the least room that holds it. A share's windows are a few hundred KB of state. Lengths run
    from 1 to ``window``; equal rows are pieces of their own; other columns travel along, and columns called like a
    result are replaced.
    """
    rows = persist_to_shared(replaced(pieces, ["sequence_id", "offset"]).withColumn("__at", F.monotonically_increasing_id()), "pieces")
    names = [c for c in rows.columns if c != "__at"]
    tails = rows.where(F.col(length) < window)
    shares = max(1, round(tails.count() / share))
    full = rows.where(F.col(length) >= window).select(*[F.col(f"`{c}`") for c in names], (F.col("__at") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    dealt = tails.withColumn("__share", F.pmod(F.xxhash64("__at"), F.lit(shares)))
    # Order by length, then by place: a share packed again after a lost executor is packed the same way.
    placed = dealt.repartitionById(shares, F.col("__share").cast("int")).sortWithinPartitions("__share", F.col(length).desc(), "__at")
    schema = rows.select(*[F.col(f"`{c}`") for c in names]).schema.add("sequence_id", "long").add("offset", "long")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = fit = None
        for batch in batches:
            at, size = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__share", length))
            numbers, offsets = [], []
            for s, n in zip(at, size, strict=True):
                if s != own:
                    own, fit = s, BestFit(window)
                number, offset = fit.place(n)
                numbers.append(2 * ((s << 32) + number))
                offsets.append(offset)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())], names=[*names, "sequence_id", "offset"])

    return placed.mapInArrow(walk, schema).unionByName(full)


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The sequences themselves, ``(sequence_id, n_tokens, n_pieces, ids)``; at most a window of tokens meet in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), ""))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), joined.alias("ids"))
