"""Pre-publish checks. Each returns findings (check, subject, detail); an empty frame passes.

Rules arrive as plain Python lists and dicts written by people, so their number is small and fixed
by the caller; they become expressions inside one scan, not joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.functions import paths
from tablewright.operators.skew import HOT_ROWS, join_per_key

FINDINGS = "check string, subject string, detail string"


def findings(df: DataFrame, check: str, subject: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail")
    )


def blocked_columns(schemas: DataFrame, patterns: list[str]) -> DataFrame:
    """Columns whose name contains a match of a forbidden pattern (an unanchored regular expression).

    ``schemas`` has one row per column of each table: (table, column, type).
    """
    hits = F.array_compact(F.array(*[F.when(F.col("column").rlike(p), F.lit(p)) for p in patterns]))
    found = schemas.select("table", "column", F.explode(hits).alias("pattern"))
    return findings(found, "blocked_column", F.concat_ws(".", "table", "column"), F.col("pattern"))


def schema_changes(published: DataFrame, incoming: DataFrame) -> DataFrame:
    """Position-by-position comparison of (table, position, column, type) rows; extra and missing columns count."""
    a = published.select("table", "position", F.col("column").alias("_c"), F.col("type").alias("_t"))
    b = incoming.select("table", "position", F.col("column").alias("_d"), F.col("type").alias("_u"))
    what = (
        F.when(F.col("_c").isNull(), F.concat(F.lit("added "), "_d"))
        .when(F.col("_d").isNull(), F.concat(F.lit("dropped "), "_c"))
        .when(F.col("_c") != F.col("_d"), F.concat(F.lit("renamed "), "_c", F.lit(" to "), "_d"))
        .when(F.col("_t") != F.col("_u"), F.concat(F.lit("retyped "), "_c", F.lit(" from "), "_t", F.lit(" to "), "_u"))
    )
    joined = a.join(b, ["table", "position"], "full_outer").withColumn("what", what).where(F.col("what").isNotNull())
    return findings(joined, "schema_change", F.concat_ws(":", "table", "position"), F.col("what"))


def file_schema_changes(published: DataFrame, files: DataFrame) -> DataFrame:
    """``schema_changes`` of every file on its own: one finding per file and column that differs from its table.

    ``published`` has rows (table, position, column, type), one schema a table, so it is about as small as the list of
    tables; ``files`` has (table, path, position, column, type). Tables that were not published before have no schema
    to keep to and pass.
    """
    known = files.join(published.select("table").distinct(), "table", "left_semi")
    expected = known.select("table", "path").distinct().join(published, "table")
    pairs = lambda df: df.select(F.concat_ws("/", "table", "path").alias("table"), "position", "column", "type")
    return schema_changes(pairs(expected), pairs(known))


def published_schema(files: DataFrame) -> DataFrame:
    """(table, position, column, type) of the first file of each table in (table, path, position, column, type)."""
    first = files.groupBy("table").agg(F.min("path").alias("path"))
    return files.join(first, ["table", "path"], "left_semi").select("table", "position", "column", "type")


def files_to_check(diff: DataFrame, suffix: str, sample: bool) -> DataFrame:
    """Changed, still existing files with the suffix; with ``sample`` the first of each folder."""
    changed = diff.where((F.col("type") != "removed") & F.col("path").endswith(suffix))
    if not sample:
        return changed.select(paths.parent(F.col("path")).alias("folder"), "path")
    return changed.groupBy(paths.parent(F.col("path")).alias("folder")).agg(F.min("path").alias("path"))


def commit_metadata(commits: DataFrame, rules: dict[str, str | None]) -> DataFrame:
    """Commits that lack a mandatory metadata key, or whose value does not contain a match of its pattern."""
    problems = []
    for key, pattern in rules.items():
        value = F.try_element_at("metadata", F.lit(key))
        bad = F.when(value.isNull(), F.lit(f"missing {key}"))
        if pattern:
            bad = bad.when(~value.rlike(pattern), F.concat(F.lit(f"{key} does not match: "), value))
        problems.append(bad)
    found = commits.select("commit_id", F.explode(F.array_compact(F.array(*problems))).alias("problem"))
    return findings(found, "commit_metadata", F.col("commit_id"), F.col("problem"))


def nearest_descriptor(objects: DataFrame, descriptors: DataFrame, name: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """For each object the descriptor file in its folder or the nearest folder above; null if there is none.

    Objects are first counted per folder, so the ancestor join carries one row per folder and depth;
    a folder that holds a large share of all objects is joined back without moving them.
    """
    folder = paths.parent(F.col("path"))
    above = F.when(F.col("folder") == "", F.array(F.lit(""))).otherwise(paths.folders(F.concat("folder", F.lit("/x"))))
    spots = (
        objects.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n"))
        .select("folder", "n", F.posexplode(above).alias("up", "at"))
        .withColumn("descriptor", paths.join(F.col("at"), F.lit(name)))
    )
    known = descriptors.select(F.col("path").alias("descriptor")).distinct()
    best = spots.join(known, "descriptor").groupBy("folder", "n").agg(F.min_by("descriptor", "up").alias("descriptor"))
    return join_per_key(objects.withColumn("folder", folder), best, ["folder"], "n", "path", "left", hot_rows).drop("folder")


def missing_descriptors(diff: DataFrame, descriptors: DataFrame, name: str) -> DataFrame:
    """Added objects that no descriptor covers; changed and removed objects are not looked at."""
    added = diff.where((F.col("type") == "added") & (paths.base_name(F.col("path")) != name)).select("path")
    bare = nearest_descriptor(added, descriptors, name).where(F.col("descriptor").isNull())
    return findings(bare, "descriptor", F.col("path"), F.lit("no dataset metadata found"))


def descriptor_fields(descriptors: DataFrame, fields: list[dict], strict: bool = False) -> DataFrame:
    """Check the string map ``fields`` of each descriptor against rules (name, required, type, choices, pattern).

    An absent optional field passes; ``strict`` fails it if it has a type or choices.
    """
    problems = []
    for rule in fields:
        name = rule["name"]
        value = F.try_element_at("fields", F.lit(name))
        kind = {
            "boolean": F.lower(value).isin("true", "false"),
            "number": value.try_cast("double").isNotNull(),
            "string": value.try_cast("double").isNull() & ~F.lower(value).isin("true", "false"),
        }
        if rule.get("required"):
            problems.append(F.when(value.isNull(), f"{name} is required"))
        elif strict and (rule.get("type") or rule.get("choices")):
            problems.append(F.when(value.isNull(), f"{name} is absent"))
        if rule.get("type"):
            problems.append(F.when(value.isNotNull() & ~kind[rule["type"]], f"{name} is not a {rule['type']}"))
        if rule.get("choices"):
            problems.append(F.when(value.isNotNull() & ~value.isin(rule["choices"]), f"{name} is not an allowed choice"))
        if rule.get("pattern"):
            problems.append(F.when(value.isNotNull() & ~value.rlike(rule["pattern"]), f"{name} does not match its pattern"))
    found = descriptors.select("path", F.explode(F.array_compact(F.array(*problems))).alias("problem"))
    return findings(found, "descriptor_field", F.col("path"), F.col("problem"))


# Type names that rules may ask for, and what Spark calls the types of values inside a parsed document.
_KINDS = {"boolean": "^BOOLEAN$", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "string": "^STRING$", "table": "^(OBJECT|ARRAY)"}


def _choice(value: Column, kind: Column, choice) -> Column:
    """Whether the value equals the choice in type and value: "3" is not 3, "true" is not true."""
    name = "boolean" if isinstance(choice, bool) else "string" if isinstance(choice, str) else "number"
    target = {"boolean": "boolean", "string": "string", "number": "double"}[name]
    return kind.rlike(_KINDS[name]) & (F.try_variant_get(value, "$", target) == F.lit(choice).cast(target))


def typed_fields(descriptors: DataFrame, fields: list[dict], strict: bool = False) -> DataFrame:
    """Check the document ``body`` (the text of a JSON object) of each descriptor against the rules of ``descriptor_fields``.

    Values keep their types: a quoted "123" is no number and a quoted "true" no boolean. A type is ``boolean``,
    ``number``, ``string`` or ``table`` (an object or a list). A null field counts as absent. A pattern asks for text.
    Choices are compared with their type. A body that is null or no JSON object is one finding of its own.
    """
    whole = descriptors.select("path", F.try_parse_json("body").alias("_doc"))
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    values, problems = [], []
    for i, rule in enumerate(fields):
        name = rule["name"]
        if '"' in name or "\\" in name:
            raise ValueError(f"field name {name!r}")
        values.append(F.try_variant_get("_doc", f'$["{name}"]', "variant").alias(f"_v{i}"))
        value = F.col(f"_v{i}")
        kind = F.schema_of_variant(value)
        there = value.isNotNull() & (kind != "VOID")
        if rule.get("required"):
            problems.append(F.when(~there, f"{name} is required"))
        elif strict and (rule.get("type") or rule.get("choices")):
            problems.append(F.when(~there, f"{name} is absent"))
        if rule.get("type"):
            problems.append(F.when(there & ~kind.rlike(_KINDS[rule["type"]]), f"{name} is not a {rule['type']}"))
        if rule.get("choices"):
            allowed = F.lit(False)
            for choice in rule["choices"]:
                allowed = allowed | F.coalesce(_choice(value, kind, choice), F.lit(False))
            problems.append(F.when(there & ~allowed, f"{name} is not an allowed choice"))
        if rule.get("pattern"):
            text = F.when(kind.rlike(_KINDS["string"]), F.try_variant_get(value, "$", "string"))
            problems.append(F.when(there & text.isNull(), f"{name} is not text"))
            problems.append(F.when(there & ~text.rlike(rule["pattern"]), f"{name} does not match its pattern"))
    parsed = whole.select("path", is_object.alias("_object"), *values)
    listed = F.when(~F.col("_object"), F.array(F.lit("not a JSON object"))).otherwise(F.array_compact(F.array(*problems)))
    return findings(parsed.select("path", F.explode(listed).alias("problem")), "descriptor_field", F.col("path"), F.col("problem"))


def file_formats(diff: DataFrame, prefix: str, suffixes: list[str], folders: tuple[str, ...] = ("_delta_log/",)) -> DataFrame:
    """Changed files below ``prefix`` that are of no allowed format."""
    allowed = F.lit(False)
    for s in suffixes:
        allowed = allowed | F.col("path").endswith(s)
    for f in folders:
        allowed = allowed | F.col("path").contains(f)
    bad = diff.where((F.col("type") != "removed") & F.col("path").startswith(prefix) & ~allowed)
    return findings(bad, "file_format", F.col("path"), paths.suffix(F.col("path")))


def freshness(source: DataFrame, tables: dict[str, DataFrame], period: Column) -> DataFrame:
    """Tables whose latest period is not the source's, empty tables included: one job over all of them."""
    latest = None
    for name, df in tables.items():
        part = df.agg(F.max(period).cast("string").alias("period")).select(F.lit(name).alias("table"), "period")
        latest = part if latest is None else latest.unionByName(part)
    late = latest.withColumn("wanted", source.agg(F.max(period).cast("string")).scalar())
    late = late.where(~F.col("period").eqNullSafe(F.col("wanted")))
    return findings(late, "freshness", F.col("table"), F.concat(F.coalesce("period", F.lit("nothing")), F.lit(" instead of "), "wanted"))


def null_dimensions(table: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that hold nulls, with the number of null rows."""
    one = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns]))
    ).where(F.col("n") > 0)
    return findings(cells, "null_dimension", F.col("column"), F.col("n"))


def membership(table: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Distinct values of a column against an expected set (column ``value``): both differences."""
    seen = table.select(F.col(column).alias("value")).distinct().withColumn("_s", F.lit(True))
    want = expected.select("value").distinct().withColumn("_w", F.lit(True))
    odd = seen.join(want, "value", "full_outer").where(F.col("_s").isNull() | F.col("_w").isNull())
    return findings(odd, "membership", F.col("value"), F.when(F.col("_s").isNull(), "missing").otherwise("unexpected"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; children are counted per key before the join."""
    per_key = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
    return findings(lost, "orphan", F.col("_k"), F.col("n"))


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Columns that are not there; only the schema is looked at."""
    missing = sorted(set(required) - set(df.columns))
    rows = [("required_column", c, "missing") for c in missing]
    return df.sparkSession.createDataFrame(rows, FINDINGS)


def non_empty(df: DataFrame, name: str) -> DataFrame:
    """One finding if the frame has no rows; reads at most one row."""
    empty = df.limit(1).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return findings(empty, "non_empty", F.lit(name), F.lit("no rows"))


def stored_status(expected: DataFrame, reports: DataFrame) -> DataFrame:
    """Subjects whose stored report is absent or not ``passed``."""
    got = reports.select("subject", "status")
    bad = expected.select("subject").join(got, "subject", "left").where(~F.coalesce(F.col("status") == "passed", F.lit(False)))
    return findings(bad, "stored_status", F.col("subject"), F.coalesce("status", F.lit("no report")))


Gate = Callable[..., DataFrame]


def run_gates(gates: list[tuple[str, Gate, dict]]) -> DataFrame:
    """All findings of a list of (id, gate, arguments) in one frame with a ``gate`` column."""
    out = None
    for gate_id, gate, args in gates:
        part = gate(**args).select(F.lit(gate_id).alias("gate"), "check", "subject", "detail")
        out = part if out is None else out.unionByName(part)
    return out


class Blocked(RuntimeError):
    """A gate found something; nothing was published."""


def require_clean(found: DataFrame) -> None:
    """Raise with the number of findings per gate if there are any."""
    counts = {r["gate"]: r["n"] for r in found.groupBy("gate").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts:
        raise Blocked(f"findings: {counts}")


def shape_schema(table: str, schema: StructType) -> list[tuple[str, int, str, str]]:
    """Rows (table, position, column, type) of a schema."""
    return [(table, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
