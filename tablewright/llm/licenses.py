"""License scans: ordered signature rules behind a keyword gate; overlapping detections are settled by priority."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import ANY_CASE_WORD, NOT_PLAIN, ascii_lower, keyed, replaced, whole

# The phrases every scan looks for, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Own rules. label: (name as words, regex allowed; keyword every match of the name contains; versions).
NAMES = {
    "apache": ("apache", "apache", ("1 0", "1 1", "2 0")),
    "mit": ("mit", "mit licen", ()),
    "x11": ("x11", "x11 licen", ()),
    "bsd": ("bsd(?: 4 clause| 3 clause| 2 clause)?", "bsd", ()),
    "isc": ("isc", "isc licen", ()),
    "zlib": ("zlib(?: libpng)?", "zlib", ()),
    "mpl": ("mozilla public", "mozilla", ("1 0", "1 1", "2 0")),
    "epl": ("eclipse public", "eclipse", ("1 0", "2 0")),
    "cddl": ("common development and distribution", "common development", ("1 0", "1 1")),
    "gpl": ("(?:gnu )?general public", "general public", ("1 0", "2", "2 0", "3", "3 0")),
    "lgpl": ("(?:gnu )?(?:lesser|library) general public", "general public", ("2", "2 0", "2 1", "3", "3 0")),
    "agpl": ("(?:gnu )?affero general public", "affero", ("1 0", "3", "3 0")),
    "gfdl": ("(?:gnu )?free documentation", "free documentation", ("1 1", "1 2", "1 3")),
    "artistic": ("artistic", "artistic licen", ("1 0", "2 0")),
    "bsl": ("boost software", "boost", ("1 0",)),
    "upl": ("universal permissive", "universal permissive", ("1 0",)),
    "eupl": ("european union public", "european union", ("1 0", "1 1", "1 2")),
    "odbl": ("open database", "open database", ("1 0",)),
    "odc-by": ("open data commons attribution", "open data commons", ("1 0",)),
    "ofl": ("(?:sil )?open font", "open font", ("1 0", "1 1")),
    "psf": ("python software foundation", "python software", ("2",)),
    "ncsa": ("(?:university of illinois )?ncsa(?: open source)?", "ncsa", ()),
    "afl": ("academic free", "academic free", ("1 2", "2 1", "3 0")),
    "osl": ("open software", "open software licen", ("1 0", "2 1", "3 0")),
    "mspl": ("microsoft public", "microsoft", ()),
    "cpl": ("common public", "common public", ("1 0",)),
    "ipl": ("ibm public", "ibm", ("1 0",)),
    "busl": ("business source", "business source", ("1 1",)),
    "sspl": ("server side public", "server side", ("1",)),
    "elastic": ("elastic", "elastic licen", ("2 0",)),
}
CREATIVE = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CREATIVE_WORDS = {"by": "attribution", "sa": "share(?: )?alike", "nc": "non(?: )?commercial", "nd": "no(?: )?derivatives?(?: works)?"}

# (label, words as a regex, keyword, confidence, priority)
NOTICES = (
    ("public-domain", "(?:dedicated to|released into|in) the public domain", "public domain", 0.8, 40),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0", 0.9, 60),
    ("unlicense", "(?:the unlicense|unlicense org)", "unlicense", 0.9, 60),
    ("wtfpl", "do what the (?:fuck|f) you want to public license", "want to public", 0.9, 60),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 0.95, 80),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "distribute this software", 0.95, 80),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary forms", 0.95, 80),
    ("apache", "www apache org licenses(?: license 2 0)?", "apache", 0.9, 70),
    ("gpl", "www gnu org licenses(?: gpl)?", "gnu org", 0.8, 50),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 0.4, 20),
    ("copyright", "copyright (?:holders?|owners?|notice)", "copyright", 0.3, 20),
    ("reserved", "no part of this", "no part of this", 0.3, 20),
    ("reserved", "may not be reproduced", "not be reproduced", 0.4, 20),
    ("reserved", "unauthorized (?:copying|reproduction)", "unauthorized", 0.4, 20),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary", 0.6, 30),
)
BASE_CONFIDENCE, LICENSE = 0.5, "licen[sc]e"


@dataclass(frozen=True)
class Rule:
    label: str
    words: str
    keyword: str
    confidence: float
    priority: int

    @property
    def pattern(self) -> str:
        """Every word of the text stands between its own two blanks, so neighbours never share one."""
        return " " + self.words.replace(" ", "  ") + " "


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, most specific first: names x versions x the ways a notice is worded."""
    out = [Rule(BASE[p], p, p, BASE_CONFIDENCE, 10) for p in BASE]
    out += [Rule(*n) for n in NOTICES]
    for label, (name, keyword, versions) in NAMES.items():
        out.append(Rule(label, f"(?:the )?{name} {LICENSE}", keyword, 0.7, 50))
        out.append(Rule(label, f"(?:licensed|released|distributed) under (?:the )?(?:terms of the )?{name}", "ed under", 0.8, 60))
        out.append(Rule(label, f"spdx license identifier {name}", "spdx", 1.0, 90))
        for v in versions:
            out.append(Rule(f"{label}-{v.replace(' ', '.')}", f"{name} {LICENSE} (?:version |v )?{v}", keyword, 0.9, 70))
            out.append(Rule(f"{label}-{v.replace(' ', '.')}", f"spdx license identifier {label.replace('-', ' ')} {v}", "spdx", 1.0, 95))
    for kind in CREATIVE:
        long = " ".join(CREATIVE_WORDS[k] for k in kind.split())
        tag = "cc-" + kind.replace(" ", "-")
        out.append(Rule(tag, f"cc {kind}", "cc by", 0.7, 50 + 2 * len(kind)))
        out.append(Rule(tag, f"creative commons {long}", "creative commons", 0.8, 50 + 2 * len(kind)))
        out.append(Rule(tag, f"creativecommons org licenses {kind}", "creativecommons", 0.9, 60 + 2 * len(kind)))
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append(Rule(f"{tag}-{v.replace(' ', '.')}", f"cc {kind} {v}", "cc by", 0.8, 70 + 2 * len(kind)))
            out.append(Rule(f"{tag}-{v.replace(' ', '.')}", f"creative commons {long} {v}", "creative commons", 0.9, 70 + 2 * len(kind)))
    return tuple(out)


def spaced(text: Column) -> Column:
    """`` w0  w1 ``: each word between its own blanks, everything else gone."""
    inner = F.btrim(F.regexp_replace(ascii_lower(text), NOT_PLAIN, "  "), F.lit(" "))
    return F.concat(F.lit(" "), inner, F.lit(" "))


def words_in(s: Column) -> Column:
    """Words of a piece cut from spaced text: two blanks each."""
    return ((F.length(s) - F.length(F.replace(s, F.lit(" ")))) / 2).cast("long")


def places(norm: Column, pattern: Column) -> Column:
    """All leftmost matches as (start, end) in words: matches and the gaps between them, added up."""
    pieces = F.arrays_zip(F.split(norm, pattern, -1).alias("gap"), F.regexp_extract_all(norm, pattern, F.lit(0)).alias("hit"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    step = lambda acc, p: F.struct(
        (acc["at"] + words_in(p["gap"]) + F.coalesce(words_in(p["hit"]), F.lit(0))).alias("at"),
        F.when(p["hit"].isNull(), acc["spans"]).otherwise(F.array_append(acc["spans"], F.struct(
            (acc["at"] + words_in(p["gap"])).alias("start"), (acc["at"] + words_in(p["gap"]) + words_in(p["hit"])).alias("end"),
        ))).alias("spans"),
    )
    return F.aggregate(pieces, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])


def rules_by_keyword() -> dict[str, Column]:
    fields = ("label", "pattern", "confidence", "priority")
    found: dict[str, list[Column]] = {}
    for i, r in enumerate(rules()):
        found.setdefault(r.keyword, []).append(F.struct(F.lit(i).alias("rule"), *[F.lit(getattr(r, f)).alias(f) for f in fields]))
    return {k: F.array(*v) for k, v in found.items()}


def suspect(text: Column, phrases: Iterable[str]) -> Column:
    """False only where none of the phrases can stand: all words of one have to occur, in any case."""
    keywords = sorted({frozenset(p.split()) for p in phrases}, key=lambda k: (len(k), sorted(k)))
    needed = [sorted(k, key=len, reverse=True) for k in keywords if not any(o < k for o in keywords)]  # fewer words stand for more

    def holds(low: Column) -> Column:
        return reduce(operator.or_, [reduce(operator.and_, [F.contains(low, F.lit(w)) for w in k]) for k in needed])

    # An array of one, so that the text is lowered once for all words. Beyond ASCII, lowering may change letters,
    # but it keeps those of a keyword.
    return F.exists(F.array(F.lower(text)), holds)


def detections(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(__id, __text, found)``: the detections that stand after suppression, for documents that have any.

    A document meets only rules whose keyword it contains. A detection inside the interval of one with a
    higher priority (then: a longer one, then an earlier rule) is suppressed. Work per document is bounded by its text.
    """
    by_keyword = rules_by_keyword()
    gated = keyed(docs.where(suspect(whole(text), by_keyword)), spaced(whole(text)).alias("norm"), text=text, key=key)
    present = F.filter(F.array(*map(F.lit, by_keyword)), lambda k: F.contains(F.col("norm"), F.replace(k, F.lit(" "), F.lit("  "))))
    named = gated.select("__id", "__text", "norm", F.explode(present).alias("keyword"))
    due = F.create_map(*[x for k, v in by_keyword.items() for x in (F.lit(k), v)])
    pairs = named.select("__id", "__text", "norm", F.explode(F.element_at(due, F.col("keyword"))).alias("r"))
    spans = pairs.select("__id", "__text", "r.rule", "r.label", "r.confidence", "r.priority", F.explode(places(F.col("norm"), F.col("r.pattern"))).alias("s"))
    # (rule, start, end) is distinct, so repeated rows of a document fold into one.
    found = spans.groupBy("__id", "__text").agg(
        F.collect_set(F.struct("s.start", "s.end", "rule", "label", "confidence", "priority")).alias("all")
    )
    rank = lambda d: F.struct(d["priority"], d["end"] - d["start"], -d["rule"])
    beaten = lambda d: F.exists("all", lambda o: (o["start"] <= d["start"]) & (d["end"] <= o["end"]) & (rank(o) > rank(d)))
    return found.select("__id", "__text", F.sort_array(F.filter("all", lambda d: ~beaten(d))).alias("found"))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_words, n_base, first_word, last_word, base_labels, labels, score, detections`` to every row.

    Null and empty texts have no words, no labels, score 0 and null first and last words. Base phrases always
    count, also where a detection of the rules suppresses them.
    """
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    kept = replaced(docs, made).columns
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(key).alias("__id"), F.xxhash64(whole(text)).alias("__text"),
                       F.when(suspect(whole(text), BASE), spaced(whole(text))).otherwise("").alias("__norm"),
                       F.regexp_count(whole(text), F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"))
    # Cut before each base phrase; "^" keeps a phrase at the very start from losing its empty first piece.
    phrases = "|".join(p.replace(" ", "  ") for p in BASE)
    cut = F.split(F.concat(F.lit("^"), F.col("__norm")), f"(?= (?:{phrases}) )", -1)
    names = F.array_sort(F.filter(F.array(*[
        F.when(F.contains("__norm", F.lit(" " + p.replace(" ", "  ") + " ")), F.lit(label)) for p, label in BASE.items()
    ]), lambda x: x.isNotNull()))
    rows = rows.select(*[c for c in rows.columns if c != "__norm"], cut.alias("__cut"), names.alias("__base"))
    base = F.size("__cut") - 1
    first = F.when(base > 0, words_in(F.element_at("__cut", 1)))
    last = F.when(base > 0, F.col("n_words") - words_in(F.element_at("__cut", -1)))
    rows = rows.select(*[c for c in rows.columns if c != "__cut"], base.cast("long").alias("n_base"), first.alias("first_word"), last.alias("last_word"))
    hits = detections(docs, key, text).select(F.col("__id").alias("h_id"), F.col("__text").alias("h_text"), "found")
    joined = rows.join(hits, F.col("__id").eqNullSafe(F.col("h_id")) & (F.col("__text") == F.col("h_text")), "left")
    found = F.coalesce(F.col("found"), F.array().cast(hits.schema["found"].dataType))
    named = F.array_sort(F.array_distinct(F.concat("__base", F.transform(found, lambda d: d["label"]))))
    sure = F.array_max(F.concat(F.transform(found, lambda d: d["confidence"]), F.array(F.when(F.col("n_base") > 0, BASE_CONFIDENCE).otherwise(0.0))))
    return joined.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", "n_base", "first_word", "last_word",
        F.array_join("__base", ",").alias("base_labels"), F.array_join(named, ",").alias("labels"),
        sure.alias("score"), found.alias("detections"),
    )
