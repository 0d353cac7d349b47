"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import replaced, whole
from tablewright.session import persist_to_shared


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` and ``rest`` count if group ``value`` has ``least`` characters."""

    kind: str
    pattern: str
    gate: str  # a cheaper pattern that every text with a match has
    value: int = 0
    least: int = 1
    rest: str = ""  # what else belongs to the span after a match of ``pattern``; may match nothing, has no groups
    before: str = ""  # a look-behind that changes no match and spares hopeless starts


# What follows the header of a private key, in files, in quoted, indented or escaped strings, or on one line: header
# fields, then base64 to the END line. Without one, runs of 40 characters or lines of 16, and one shorter line after them.
_GAP = r"""(?:[\s"'`>|#*,+]|\\[nrt]?)*+"""
_BREAK = r"""(?:[\x20\t"'`>|#*,+]*+(?:\\?(?:\r\n?|\n)|\\[nr]))"""
_B64 = r"(?:[A-Za-z0-9+/=]|\\/|\\u00[0-9A-Fa-f]{2})"
_LINE_END = rf"""(?={_BREAK}|["'`]|\s*+\z)"""
_FIELD = (
    r"(?:Proc-Type:\x20*+4,ENCRYPTED|DEK-Info:\x20*+[A-Za-z0-9-]++,[0-9A-Fa-f]++"
    r"|[A-Za-z][A-Za-z0-9-]*+:(?:(?![A-Za-z0-9+/=]{40})[^\r\n\\])*+)"
)
KEY_BODY = (
    f"(?:(?:{_GAP}{_FIELD})*+(?:"
    f"(?:{_GAP}{_B64}{{16,}}+|{_BREAK}{_GAP}{_B64}++{_LINE_END})++(?:{_GAP}{_B64}++)?+{_GAP}-----END [A-Z ]*PRIVATE KEY-----"
    f"|(?:{_GAP}{_B64}{{40,}}+|{_BREAK}{_GAP}{_B64}{{16,}}+{_LINE_END})++(?:{_BREAK}{_GAP}{_B64}++{_LINE_END})?+))?+"
)

# The three base kinds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"(?i:password|passwd|secret|token|api_?key)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA", 0, 16),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{32}", 0, 32),
)
# The scan's own kinds.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY", rest=KEY_BODY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", "AIza", 0, 39),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]+", "k_live_", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ", 0, 40),
    # Only the start of a run of letters is tried: any later start matches only where that one does.
    Rule("login", r"[a-z]+://[^\x20/:@]+:([^\x20/:@]+)@", "://", 1, 6, before="(?<![a-z])"),
)
RULES = BASE + MORE
VERSION = "2"  # raise it with any change of a rule: blobs are scanned once per version

SPANS = "array<struct<start:int,kind:int,end:int>>"


BLOCK = 256  # lists that grow one by one are copied each time, so they are grown in blocks


def _once(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` names it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _spans_of_block(pieces: Column, at: Column, number: int, least: int) -> Column:
    step = lambda acc, p: F.struct(
        (acc["at"] + p["gap"] + F.coalesce(p["hit"], F.lit(0))).alias("at"),
        F.when(p["value"] >= least, F.array_append(acc["spans"], F.struct(
            (acc["at"] + p["gap"]).alias("start"), F.lit(number).alias("kind"), (acc["at"] + p["gap"] + p["hit"]).alias("end"),
        ))).otherwise(acc["spans"]).alias("spans"),
    )
    return F.aggregate(pieces, F.struct(at.alias("at"), F.array().cast(SPANS).alias("spans")), step, lambda acc: acc["spans"])


def rule_spans(text: Column, number: int, rule: Rule) -> Column:
    """Spans of one rule in code points: matches and the gaps between them, added up block by block.

    The work grows with the length of the text, also for a text with very many matches.
    """
    pattern = rule.before + rule.pattern + rule.rest
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.value)) if rule.value else hits
    lengths = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("hit"), F.length(p["value"]).alias("value")),
    )
    cut = lambda pieces: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK))
    )
    total = lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + p["gap"] + F.coalesce(p["hit"], F.lit(0)))
    starts = lambda blocks: F.aggregate(
        blocks, F.array(F.lit(0)), lambda at, block: F.array_append(at, F.element_at(at, -1) + total(block))
    )
    placed = lambda blocks: F.flatten(F.zip_with(
        blocks, F.slice(starts(blocks), F.lit(1), F.size(blocks)), lambda block, at: _spans_of_block(block, at, number, rule.least)
    ))
    found = _once(_once(lengths, cut), placed)
    return F.when(text.rlike(rule.gate), found).otherwise(F.array().cast(SPANS))


def scan(blobs: DataFrame, rules=RULES, version: str = VERSION) -> DataFrame:
    """Ledger rows ``(blob, rule_version, spans)`` for texts ``(blob, text)``; spans by start, then kind."""
    each = F.concat(*[rule_spans(F.col("text"), i, r) for i, r in enumerate(rules)])
    return blobs.select("blob", F.lit(version).alias("rule_version"), F.sort_array(each).alias("spans"))


def suspect(text: Column, rules=RULES) -> Column:
    """False only where no rule can match."""
    return text.rlike("|".join(r.gate for r in rules))


def scan_secrets(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES, version: str = VERSION,
                 text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan every version of every path once per content and rule version.

    ``versions`` has one row per path and version with its text; ``ledger`` holds what earlier runs scanned.
    Returns the rows of ``versions`` with ``blob`` (the address of the content) and ``spans`` added, and the
    ledger with the new entries. Contents no rule can match get no entry: the gate is itself the whole scan.
    A null text is an empty one; rows are kept one for one, repeated rows share one scan.
    """
    kept = replaced(versions, ["blob", "spans"]).columns
    columns = [F.col(f"`{c}`") for c in kept]
    blob = F.sha2(whole(text), 256)
    found = versions.where(suspect(whole(text), rules)).select(blob.alias("blob"), whole(text).alias("text")).dropDuplicates(["blob"])
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == version).select("blob")
        found = found.join(known, "blob", "left_anti")
    entries = persist_to_shared(scan(found, rules, version), "ledger")
    grown = entries if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(entries)
    findings = grown.where((F.col("rule_version") == version) & (F.size("spans") > 0)).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    # Only rows that can have a finding meet the ledger; the others keep their place, and their texts stay put.
    none = F.array().cast(SPANS)
    clean = versions.where(~suspect(whole(text), rules)).select(*columns, blob.alias("blob"), none.alias("spans"))
    rows = versions.where(suspect(whole(text), rules)).select(*columns, blob.alias("blob"))
    out = rows.join(findings, F.col("blob") == F.col("__blob"), "left")
    return clean.union(out.select(*columns, "blob", F.coalesce("__spans", none).alias("spans"))), grown


def named_spans(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span overwritten by ``[secret]``; overlapping spans become one."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["to"], s["end"]).alias("to"),
        F.when(s["end"] <= acc["to"], acc["out"]).otherwise(F.concat(
            acc["out"], F.when(s["start"] > acc["to"], F.concat(F.substring(text, acc["to"] + 1, s["start"] - acc["to"]), F.lit("[secret]")))
            .when(acc["to"] == 0, F.lit("[secret]")).otherwise(F.lit("")),
        )).alias("out"),
    )
    return F.aggregate(spans, F.struct(F.lit(0).alias("to"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["to"] + 1, F.length(text))))
