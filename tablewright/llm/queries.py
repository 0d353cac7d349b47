"""The registered queries of this package, over whole tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    decontaminate,
    html_text,
    licenses,
    merkle,
    mixing,
    near_copies,
    oracles,
    packing,
    phrases,
    quality,
    repeats,
    secrets,
    toxicity,
    url_lists,
)
from tablewright.llm.shared import ascii_lower, whole, word_count
from tablewright.session import apply_settings

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        _QUERIES[name] = lambda spark, sf_dir: fn(_reader(spark, sf_dir))
        if sql:
            _SQL[name] = sql
        return fn

    return add


def _reader(spark: SparkSession, sf_dir: str):
    apply_settings(spark)
    return lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op1_license_scan", oracles.OP1)
def op1(table):
    rows = table("documents").select("doc_id", "text")
    return licenses.scan_licenses(rows).drop("text", "detections")


@query("op7_secret_scan", oracles.OP7)
def op7(table):
    rows = table("documents").select("doc_id", "text")
    found, _ = secrets.scan_secrets(rows)
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(secrets.BASE)],
        F.sha2(secrets.named_spans(base), 256).alias("base_sha256"), secrets.named_spans(F.col("spans")).alias("spans"),
    )


@query("op9_mix_sources", oracles.OP9)
def op9(table):
    rows = table("documents").select("doc_id", "source", word_count(F.col("text")).alias("n_words"), F.xxhash64(whole("text")).cast("string").alias("hash"))
    return mixing.mix_plan(rows, size=F.col("n_words"), text="hash").select("doc_id", "size", "source_size", "target", "taken")


@query("op10_decontaminate", oracles.OP10)
def op10(table):
    rows = table("documents").select("doc_id", "text")
    return decontaminate.decontaminate(rows, table("benchmark")).drop("text")


@query("op3_quality_rules", oracles.OP3)
def op3(table):
    return quality.quality(table("documents").select("doc_id", "text"))


@query("op5_ngram_jaccard", oracles.OP5)
def op5(table):
    found = near_copies.similar_documents(table("documents").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op8_toxicity")
def op8(table):
    found = toxicity.score_toxicity(table("documents").select("doc_id", "text"), table("labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op4_suffix_dedup", oracles.OP4)
def op4(table):
    found = repeats.remove_repeats(table("documents").select("doc_id", "text"), keep_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_html_extraction")
def op2(table):
    return html_text.extract(table("pages").select("page_id", "url", "html"))


@query("op11_merkle_manifest", oracles.OP11)
def op11(table):
    rows = table("documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    manifest = merkle.build(rows, ["doc_id", "source", "lang", "n_chars", "text"], presented={"text": tampered})
    return merkle.audit(manifest).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified"
    )


@query("op12_phrase_mining", oracles.OP12)
def op12(table):
    return phrases.collocations(table("documents").select("lang", "text")).drop("n_words", "cut")


@query("op13_sequence_packing")
def op13(table):
    cut = packing.pieces(table("documents").select("doc_id", "text"))
    narrow = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(narrow)


# Pages carry no fetch time and there is no table of lists: both are derived from the pages themselves. A site
# (three labels) is on the block list for a time that its hash names, some twice; some hosts are on an allow list.
DIGIT = "(instr('0123456789abcdef', substr(md5({0}), {1}, 1)) - 1)"


def _entries(table) -> DataFrame:
    hosts = table("pages").select(url_lists.host(F.col("url")).alias("host")).where("host is not null").distinct()
    sites = hosts.select("host", F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("site"))
    d = lambda what, i: F.expr(DIGIT.format(what, i))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    listed = sites.where((F.col("site") != "") & (d("site", 1) < 6)).select("site").distinct()
    turns = F.array(
        F.struct(day(d("site", 2) * 12).alias("day"), F.lit("add").alias("op")),
        F.struct(day(d("site", 2) * 12 + d("site", 3) * 9).alias("day"), F.lit("remove").alias("op")),
        F.struct(day(d("site", 2) * 12 + d("site", 3) * 9 + d("site", 4) * 7).alias("day"), F.lit("add").alias("op")),
    )
    blocked = listed.select(F.lit("block").alias("list"), F.col("site").alias("pattern"), F.explode(turns).alias("t")).select("list", "pattern", "t.day", "t.op")
    allowed = hosts.where(d("host", 5) < 2).select(F.lit("allow").alias("list"), F.col("host").alias("pattern"), day(d("host", 6) * 20).alias("day"), F.lit("add").alias("op"))
    return blocked.union(allowed)


OP6_SQL = r"""
with caps as (
    select page_id, url, date '2024-01-01' + cast((page_id * 7919) % 365 as int) as fetched,
           nullif(lower(regexp_extract(trim(url), '^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1)), '') as host
    from pages),
hosts as (select distinct host, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) as site from caps where host is not null),
listed as (
    select distinct site, instr('0123456789abcdef', substr(md5(site), 2, 1)) - 1 as a, instr('0123456789abcdef', substr(md5(site), 3, 1)) - 1 as b,
           instr('0123456789abcdef', substr(md5(site), 4, 1)) - 1 as c
    from hosts where site <> '' and instr('0123456789abcdef', substr(md5(site), 1, 1)) - 1 < 6),
entries as (
    select 'block' as list, site as pattern, date '2024-01-01' + cast(a * 12 as int) as day, 'add' as op from listed
    union all select 'block', site, date '2024-01-01' + cast(a * 12 + b * 9 as int), 'remove' from listed
    union all select 'block', site, date '2024-01-01' + cast(a * 12 + b * 9 + c * 7 as int), 'add' from listed
    union all select 'allow', host, date '2024-01-01' + cast((instr('0123456789abcdef', substr(md5(host), 6, 1)) - 1) * 20 as int), 'add'
              from hosts where instr('0123456789abcdef', substr(md5(host), 5, 1)) - 1 < 2),
daily as (select list, pattern, day, max(op) as op from entries group by all),
turns as (
    select *, lead(day) over (partition by list, pattern order by day) as until from (
        select *, lag(op) over (partition by list, pattern order by day) as before from daily)
    where op = 'add' and coalesce(before, '') <> 'add' or op = 'remove' and before = 'add'),
spans as (select list, pattern, day as since, coalesce(until, date '9999-12-31') as until from turns where op = 'add'),
named as (
    select distinct host, fetched, unnest(list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
           lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))) as name
    from caps where host is not null),
best as (
    select n.host, n.fetched, min(struct_pack(n := -length(pattern), list := list, pattern := pattern, since := since)) as b
    from named n join spans s on n.name = s.pattern and s.since <= n.fetched and n.fetched < s.until group by all)
select page_id, url, c.fetched, c.host, coalesce(b.list <> 'allow', false) as blocked, b.pattern as pattern, b.list as list, b.since as since
from caps c left join best using (host, fetched)
"""


@query("op6_url_filters", OP6_SQL)
def op6(table):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 365).cast("int"))
    captures = table("pages").select("page_id", "url", day.alias("fetched"))
    return url_lists.judge(captures, _entries(table)).select("page_id", "url", "fetched", "host", "blocked", "pattern", "list", "since")
