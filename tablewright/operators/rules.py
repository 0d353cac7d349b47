"""Three-phase order rules: structure, format, business limits. One pass yields all findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.dates import calendar_date, parse_date
from tablewright.functions.numbers import real, to_number
from tablewright.functions.text import one_of, quoted, tidy, tidy_lower
from tablewright.operators.dedup import later_duplicates
from tablewright.operators.skew import HOT_ROWS

# Fixed values of the order contract.
STATUSES = ["completed", "pending", "shipped", "cancelled"]
CATEGORIES = ["electronics", "clothing", "books", "home", "sports"]
CURRENCY = "USD"
AMOUNT_CEILING = 350.00
MIN_YEAR = 2023
PHASES = {1: "Structural Integrity", 2: "Format & Value Conformance", 3: "Business Rules"}

# What the rules look at, parsed once per row.
_PARSED = {
    "id": tidy("order_id"),
    "customer": tidy("customer_id"),
    "amount": to_number("amount"),
    "day": calendar_date("order_date"),
    "year": f"try_cast(substring({tidy('order_date')}, 1, 4) AS int)",
    "currency": tidy("currency"),
    "status": tidy("status"),
    "category": tidy("product_category"),
}

# Rule name → phase and the condition that breaks it.
ROW_RULES = {
    "order_id_required": (1, "p.id = ''"),
    "customer_id_required": (1, "p.customer = ''"),
    "amount_parseable": (1, "p.amount IS NULL"),
    "order_date_format": (2, "p.day IS NULL"),
    "amount_positive": (2, f"{real('p.amount')} <= 0"),
    "currency_usd": (2, f"p.currency <> {quoted(CURRENCY)}"),
    "status_valid": (2, f"NOT {one_of('p.status', STATUSES)}"),
    "product_category_valid": (2, f"NOT {one_of('p.category', CATEGORIES)}"),
    "date_recency": (3, f"p.day IS NOT NULL AND p.year < {MIN_YEAR}"),
    "amount_ceiling": (3, f"{real('p.amount')} > {AMOUNT_CEILING}D"),
}
UNIQUE_RULE = (1, "order_id_unique")


def _parse(orders: DataFrame, *keep: str) -> DataFrame:
    """Rows with a struct ``p``. inline keeps the optimizer from copying the parsing into every rule."""
    fields = ", ".join(f"'{name}', {sql}" for name, sql in _PARSED.items())
    return orders.select(*keep, F.expr(f"inline(array(named_struct('p', named_struct({fields}))))"))


def order_findings(orders: DataFrame, phases: tuple[int, ...] = (1, 2, 3), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Findings (phase, rule, row_no). Only the uniqueness rule needs a shuffle, of ids that repeat."""
    checks = ", ".join(
        f"CASE WHEN {broken} THEN named_struct('phase', {phase}, 'rule', {quoted(rule)}) END"
        for rule, (phase, broken) in ROW_RULES.items()
        if phase in phases
    )
    found = _parse(orders, "row_no").select("row_no", F.expr(f"inline(array_compact(array({checks})))"))
    found = found.select("phase", "rule", "row_no")
    phase, rule = UNIQUE_RULE
    if phase in phases:
        ids = orders.select("row_no", F.expr(f"nullif({tidy('order_id')}, '')").alias("id"))
        again = later_duplicates(ids, F.col("id"), "row_no", hot_rows)
        found = found.unionByName(again.selectExpr(f"{phase} AS phase", f"{quoted(rule)} AS rule", "row_no"))
    return found


def first_failing_phase(found: DataFrame) -> DataFrame:
    """Only the findings of the lowest phase that has any."""
    counts = found.groupBy("phase", "rule").agg(F.count(F.lit(1)).alias("n"))
    return found.where(F.col("phase") == counts.agg(F.min("phase")).scalar())


def report(orders: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row: status, first failing phase and its name, rows looked at, and ``rule:rows`` of that phase.

    There are as many (phase, rule) counts as rules, so the last steps handle a dozen rows.
    """
    counts = order_findings(orders, hot_rows=hot_rows).groupBy("phase", "rule").agg(F.count(F.lit(1)).alias("n"))
    per_phase = counts.groupBy("phase").agg(
        F.expr("array_join(array_sort(collect_list(concat(rule, ':', n))), ',')").alias("failures")
    )
    first = per_phase.agg(F.min_by(F.struct("phase", "failures"), "phase").alias("f"))
    rows = orders.agg(F.count(F.lit(1))).scalar()
    names = " ".join(f"WHEN {phase} THEN {quoted(name)}" for phase, name in PHASES.items())
    return first.withColumn("row_count", rows).selectExpr(
        "if(f IS NULL, 'passed', 'failed') AS status",
        "coalesce(f.phase, 0) AS failed_phase",
        f"CASE f.phase {names} ELSE 'All phases passed' END AS phase_name",
        "row_count",
        "coalesce(f.failures, '') AS failures",
    )


def rule_summary(found: DataFrame, block_rows: int = 1000) -> DataFrame:
    """Affected row numbers per rule, as lists over blocks of ``block_rows`` row numbers.

    A rule that fails a third of the table still yields many short lists instead of one huge one.
    """
    block = F.floor(F.col("row_no") / block_rows)
    return found.groupBy("phase", "rule", block.alias("row_block")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_list("row_no")).alias("affected_rows")
    )


def repair_orders(orders: DataFrame) -> DataFrame:
    """Normalise case and date spelling, then drop every row that still breaks a rule. Nothing is invented:
    a date that could be read day first or month first is not touched, so its row goes.
    """
    fixes = {
        "order_id": "trim(order_id)",
        "customer_id": "trim(customer_id)",
        "order_date": f"coalesce(date_format({parse_date('order_date', guess=False)}, 'yyyy-MM-dd'), order_date)",
        "amount": "trim(amount)",
        "currency": "upper(trim(currency))",
        "status": tidy_lower("status"),
        "product_category": tidy_lower("product_category"),
    }
    fields = ", ".join(f"'{name}', {sql}" for name, sql in fixes.items())
    fixed = orders.select("row_no", F.expr(f"inline(array(named_struct({fields})))"))  # dates are parsed once
    broken = " OR ".join(f"coalesce({condition}, false)" for _, condition in ROW_RULES.values())
    valid = _parse(fixed, *fixed.columns).where(f"NOT ({broken}) AND NOT isnan(p.amount)").drop("p")
    # The first row of each id: one combining exchange, however often an id repeats.
    first = valid.groupBy("order_id").agg(F.min_by(F.struct(*valid.columns), "row_no").alias("_row"))
    return first.select("_row.*")
