"""Find benchmark items inside documents: a set join on the rarest word of each item window, verified word by word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import ANY_CASE_WORD, ascii_lower, keyed, replaced, whole
from tablewright.session import persist_to_shared

WINDOW = 10
BROADCAST_BYTES = 64 << 20  # measured size of the window table up to which it is sent to every task

RESULT = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(text):
    """All words, in the case of the text: lower-casing waits until a candidate is verified."""
    return F.regexp_extract_all(whole(text), F.lit(ANY_CASE_WORD), F.lit(0))


def item_windows(items: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows ``(win_words, win_items)`` of all items; an item shorter than a window is one window."""
    listed = items.select(F.col(item).cast("string").alias("item"), words(ascii_lower(whole(text))).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = listed.where("size(w) > 0").select("item", "w", F.explode(starts).alias("at"))
    # A null item id has no name to report, but its windows still count as hits.
    return cut.groupBy(F.slice("w", F.col("at"), F.lit(window)).alias("win_words")).agg(F.collect_set("item").alias("win_items"))


def rarest_first(windows: DataFrame, docs: DataFrame, send, text: str = "text") -> DataFrame:
    """Add the necessary prefix of each window: its rarest word in the corpus and where it stands.

    Exact containment needs every word of the window, so the prefix of the rarity order has length one.
    """
    vocabulary = windows.select(F.explode("win_words").alias("token")).distinct()
    seen = docs.select(F.explode(words(text)).alias("word")).select(F.lower("word").alias("word"))
    counts = seen.join(send(vocabulary.select(F.lower("token").alias("known")).distinct()), F.col("word") == F.col("known"))
    counts = counts.groupBy(F.col("known")).agg(F.count("*").alias("seen"))
    rarity = vocabulary.join(counts, F.lower("token") == F.col("known"), "left").select("token", F.coalesce("seen", F.lit(0)).alias("seen"))
    spread = windows.select("win_words", "win_items", F.posexplode("win_words").alias("skip", "token"))
    return spread.join(rarity, "token").groupBy("win_words").agg(
        F.min(F.struct("seen", "token", "skip")).alias("first"), F.first("win_items").alias("win_items")
    ).select(F.lower("first.token").alias("token"), F.col("first.skip").alias("skip"), "win_words", "win_items")


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified hits ``(__id, __text, start, length, win_items)``: where a window's words stand in a document."""
    windows = persist_to_shared(item_windows(items, window, text=text), "windows")
    size = windows.agg(
        F.coalesce(F.sum(F.length(F.concat_ws(" ", "win_words")) * 4 + F.size("win_items") * 32 + 64), F.lit(0)).alias("b")
    ).first()["b"]
    small = size <= broadcast_bytes
    send = F.broadcast if small else (lambda df: df)
    prefix = persist_to_shared(rarest_first(windows, docs, send, text), "prefix")
    start = F.col("pos") - F.col("skip")
    length = F.size("win_words")
    in_bounds = (start >= 0) & (start + length <= F.col("n"))
    same = lambda w: ascii_lower(F.concat_ws(" ", F.slice(w, start + 1, length))) == F.concat_ws(" ", "win_words")
    split = keyed(docs, words(text).alias("__w"), text=text, key=key)
    tokens = split.select("__id", "__text", "__w", F.size("__w").alias("n"), F.posexplode("__w").alias("pos", "word"))
    if small:
        found = tokens.join(send(prefix), (F.lower("word") == F.col("token")) & in_bounds & same("__w"))
    else:
        # Too many windows for every task: candidates travel without the text, which meets them once per document.
        narrow = tokens.drop("__w").withColumn("word", F.lower("word"))
        candidates = narrow.join(prefix, (F.col("word") == F.col("token")) & in_bounds)
        candidates = candidates.select(F.col("__id").alias("c_id"), F.col("__text").alias("c_text"), "pos", "skip", "win_words", "win_items").distinct()
        texts = split.dropDuplicates(["__id", "__text"])
        found = texts.join(candidates, F.col("__id").eqNullSafe(F.col("c_id")) & (F.col("__text") == F.col("c_text")) & same("__w"))
    return found.select("__id", "__text", start.alias("start"), length.alias("length"), "win_items")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
                  key: str = "doc_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """Add ``n_words, n_hit, n_items, items_sha256, contaminated`` to every row of ``docs``.

    A word inside any occurrence of a window of ``window`` item words is hit. Null and empty texts have no
    words and no hits; so have null items. Rows with the same id and text get the same result once each.
    """
    items = items if item_text == text else items.withColumnRenamed(item_text, text)
    hits = occurrences(docs, items, window, broadcast_bytes, key, text)
    per_doc = hits.groupBy("__id", "__text").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("win_items")))).alias("items"),
    )
    covered = F.aggregate(
        "runs", F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["to"], r["start"] + r["length"]).alias("to"),
            (acc["n"] + F.greatest(F.lit(0), r["start"] + r["length"] - F.greatest(acc["to"], r["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    per_doc = per_doc.select(F.col("__id").alias("h_id"), F.col("__text").alias("h_text"), covered.alias("__hit"), F.col("items").alias("__items"))
    rows = replaced(docs, RESULT).select("*", F.col(key).alias("__id"), F.xxhash64(whole(text)).alias("__text"),
                                         F.regexp_count(whole(text), F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"))
    joined = rows.join(per_doc, F.col("__id").eqNullSafe(F.col("h_id")) & (F.col("__text") == F.col("h_text")), "left")
    hit = F.coalesce(F.col("__hit"), F.lit(0)).cast("long")
    return joined.select(
        *[F.col(f"`{c}`") for c in replaced(docs, RESULT).columns], "n_words", hit.alias("n_hit"),
        F.coalesce(F.size("__items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("__items", ","), F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no window of any item occurs; null and empty texts stay."""
    hits = occurrences(docs, items, window, broadcast_bytes, key, text).select(F.col("__id").alias("h_id"), F.col("__text").alias("h_text")).distinct()
    same = F.col(key).eqNullSafe(F.col("h_id")) & (F.xxhash64(whole(text)) == F.col("h_text"))
    return docs.join(hits, same, "left_anti")
