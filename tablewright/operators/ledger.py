"""Receipts → ledger: triage, required fields, business rules, uniqueness, accounting and the re-check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.dates import to_iso_date
from tablewright.functions.numbers import differs, parse_amount
from tablewright.functions.text import present, quoted, tidy, tidy_upper
from tablewright.operators.dedup import keep_first, shared_keys
from tablewright.operators.skew import HOT_ROWS

# Fixed values of the receipt policy.
POLICY_CAP = 500.00
MIN_YEAR = 2023
MAX_YEAR = 2099
CURRENCY = "USD"
REQUIRED = ["vendor", "date", "total", "currency"]

# The reasons of the per-receipt judge, each with the condition that earns it. Among
# conditions of one group only the first that holds is reported.
_JUDGE = [
    [("vendor = ''", "'missing vendor'")],
    [("total IS NULL", "'missing or unparseable total'")],
    [(f"check_sum AND {differs('total', 'item_sum')}", "format_string('total %.2f != sum(line items) %.2f', total, item_sum)")],
    [
        ("date_iso = '' AND date_raw = ''", "'missing date'"),
        ("date_iso = ''", "concat('unparseable date (\\'', date_raw, '\\')')"),
        ("date_iso > {today}", "concat('future-dated (', date_iso, ')')"),
        (f"year < {MIN_YEAR}", f"concat('stale date (', date_iso, ', before {MIN_YEAR})')"),
    ],
    [("currency = ''", "'missing currency'"), (f"currency <> '{CURRENCY}'", f"concat('non-{CURRENCY} currency (', currency, ')')")],
    [("total > {cap}", "format_string('total %.2f exceeds policy cap %.2f', total, {cap})")],
]
_DUPLICATE = [("n_same > 1", "concat('duplicate invoice number (', invoice_no, ')')")]

# The same for the independent check before publishing.
_GATE = [
    [("vendor = ''", "'missing vendor'")],
    [("total IS NULL", "'missing/unparseable total'")],
    [(f"check_sum AND {differs('total', 'item_sum')}", "'total != sum(line items)'")],
    [("total > {cap}", "concat('total exceeds cap ', {cap})")],
    [("currency = ''", "'missing currency'"), (f"currency <> '{CURRENCY}'", f"concat('non-{CURRENCY} currency (', currency, ')')")],
    [("date_iso = ''", "'missing/unparseable date'"), ("date_iso > {today}", "concat('future-dated (', date_iso, ')')")],
    [(f"year <> 0 AND year NOT BETWEEN {MIN_YEAR} AND {MAX_YEAR}", "concat('date year out of range (', date_iso, ')')")],
    _DUPLICATE,
]


def _reasons(groups: list, today: str = "", cap: float = POLICY_CAP) -> Column:
    """Array of the reasons that apply."""
    cases = [" ".join(f"WHEN {when} THEN {text}" for when, text in group) for group in groups]
    array = ", ".join(f"CASE {c} END" for c in cases).replace("{today}", quoted(today)).replace("{cap}", f"{float(cap)}D")
    return F.expr(f"array_compact(array({array}))")


def gate_inputs(receipts: DataFrame) -> DataFrame:
    """Typed fields from a raw record (vendor, date, currency, total, invoice_no, line_items[{name, amount}]).

    ``check_sum`` says whether every line item is a number; only then is ``item_sum`` comparable.
    """
    typed = receipts.selectExpr(
        "source_file",
        f"{tidy('vendor')} AS vendor",
        f"{tidy_upper('currency')} AS currency",
        f"{parse_amount('total')} AS total",
        f"transform(coalesce(line_items, array()), it -> {parse_amount('it.amount')}) AS amounts",
        f"inline(array(named_struct('date_iso', {to_iso_date('date')})))",  # parsed once
        f"{tidy('date')} AS date_raw",
        f"{tidy('invoice_no')} AS invoice_no",
    )
    return typed.selectExpr(
        "source_file", "vendor", "currency", "total",
        "size(amounts) > 0 AND forall(amounts, a -> a IS NOT NULL) AS check_sum",
        "aggregate(amounts, 0D, (s, a) -> s + coalesce(a, 0D)) AS item_sum",
        "date_iso", "date_raw",
        "if(date_iso = '', 0, cast(substring(date_iso, 1, 4) AS int)) AS year",
        "invoice_no",
    )


def missing_fields(receipts: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Receipts with blank required fields and their names."""
    names = ", ".join(f"CASE WHEN NOT {present(c)} THEN {quoted(c)} END" for c in required)
    return receipts.selectExpr("source_file", f"array_compact(array({names})) AS missing").where(F.size("missing") > 0)


def receipt_rules(typed: DataFrame, today: str, cap: float = POLICY_CAP) -> DataFrame:
    """Per-receipt verdict: outcome and the list of broken rules."""
    return typed.withColumn("reasons", _reasons(_JUDGE, today, cap)).withColumn(
        "outcome", F.when(F.size("reasons") == 0, "accepted").otherwise("rejected")
    )


def apply_uniqueness(drafts: DataFrame, verdicts: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Final verdicts: a draft without one is rejected, and so is every bearer of a repeated invoice number.

    ``drafts`` (source_file, invoice_no), ``verdicts`` (source_file, outcome, reasons).
    """
    counted = shared_keys(
        drafts.select("source_file", "invoice_no"), F.expr(f"nullif({tidy('invoice_no')}, '')"), "source_file", hot_rows
    )
    judged = counted.join(verdicts.select("source_file", "outcome", "reasons"), "source_file", "left")
    final = judged.select(
        "source_file", "outcome",
        F.concat(
            F.expr("if(outcome IS NULL, array('validator produced no outcome'), coalesce(reasons, array()))"), _reasons([_DUPLICATE])
        ).alias("reasons"),
    )
    return final.selectExpr(
        "source_file", "if(coalesce(outcome = 'accepted', false) AND size(reasons) = 0, 'accepted', 'rejected') AS outcome", "reasons"
    )


def triage(inbox: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """First reason to drop a file: byte-identical to an earlier one, unreadable, not a receipt; else null.

    ``inbox`` (file, digest, readable, is_receipt). Copies of one content may be very many.
    """
    return keep_first(inbox, F.col("digest"), "file", hot_rows).selectExpr(
        "file",
        """CASE WHEN survivor <> file THEN concat('exact duplicate of ', survivor)
        WHEN NOT readable THEN 'corrupt / unreadable file' WHEN NOT is_receipt THEN 'not a receipt' END AS reason""",
    )


def accounting(inbox: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Problems of a run: (problem, phase, source_file). No rows means the books are complete.

    Every inbox file must be decided exactly once and nothing else may be; no accepted row may
    carry a reason; something must be accepted.
    """
    per_file = outcomes.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"count_if(outcome = 'accepted' AND {present('reason')})").alias("bad")
    )
    files = inbox.select("source_file").distinct().withColumn("_in", F.lit(True))
    each = files.join(per_file, "source_file", "full_outer").select(
        F.expr(
            """inline(array_compact(array(
            CASE WHEN n IS NULL THEN named_struct('problem', 'unaccounted', 'phase', 1) END,
            CASE WHEN _in IS NULL THEN named_struct('problem', 'unexpected', 'phase', 1) END,
            CASE WHEN n > 1 THEN named_struct('problem', 'double-counted', 'phase', 1) END,
            CASE WHEN bad > 0 THEN named_struct('problem', 'accepted with a reason', 'phase', 3) END)))"""
        ),
        "source_file",
    )
    none = outcomes.agg(F.expr("count_if(outcome = 'accepted')").alias("ok")).where("ok = 0")
    return each.unionByName(none.selectExpr("'nothing accepted' AS problem", "2 AS phase", "cast(NULL AS string) AS source_file"))


def recheck(typed: DataFrame, decided: DataFrame, today: str, cap: float = POLICY_CAP, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Accepted rows that break policy when judged again from the typed fields: (source_file, why).

    Only this direction blocks; a rejected row that looks fine does not. Invoice numbers are
    counted over the whole batch, rejected rows included.
    """
    counted = shared_keys(typed, F.nullif(F.col("invoice_no"), F.lit("")), "source_file", hot_rows)
    accepted = decided.where(F.col("decided") == "accepted").select("source_file")
    return counted.withColumn("why", _reasons(_GATE, today, cap)).where(F.size("why") > 0).join(accepted, "source_file", "left_semi").select("source_file", "why")


def count_mismatch(decided: DataFrame, reported: int) -> DataFrame:
    """One row if the self-reported number of accepted rows is wrong."""
    return decided.agg(F.count_if(F.col("decided") == "accepted").alias("accepted")).where(F.col("accepted") != reported)


def split_ledger(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ledger, rejects): accepted rows, and all others with the deciding phase and reason."""
    accepted = F.col("outcome") == "accepted"
    return outcomes.where(accepted), outcomes.where(~accepted).select("source_file", "outcome", "phase", "reason")


def ledger_rows(accepted: DataFrame, receipts: DataFrame) -> DataFrame:
    """The ledger as people read it: ISO dates, upper-case currency, plain two-digit totals, item counts."""
    rows = receipts.selectExpr(
        "source_file", "vendor", "invoice_no", f"coalesce(nullif({to_iso_date('date')}, ''), {tidy('date')}) AS date",
        "upper(coalesce(currency, '')) AS currency", f"format_string('%.2f', {parse_amount('total')}) AS total",
        "size(line_items) AS num_items",
    )
    return rows.join(accepted.select("source_file"), "source_file", "left_semi")
