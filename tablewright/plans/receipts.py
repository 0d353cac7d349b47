"""Registered queries: the receipt ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import ledger
from tablewright.plans.registry import query
from tablewright.plans.shapes import joined_list
from tablewright.session import persist_to_shared

TODAY = "2026-02-27"

_NUM = "TRY_CAST(trim(replace(replace({}, '$', ''), ',', '')) AS DOUBLE)"
_TYPED = f"""typed AS (SELECT source_file, trim(vendor) AS vendor, upper(trim(currency)) AS currency, {_NUM.format('total')} AS total,
    {_NUM.format('goods')} IS NOT NULL AND {_NUM.format('fee')} IS NOT NULL AS check_sum,
    coalesce({_NUM.format('goods')}, 0) + coalesce({_NUM.format('fee')}, 0) AS item_sum, date_iso,
    CASE WHEN date_iso <> '' THEN CAST(substr(date_iso, 1, 4) AS INTEGER) ELSE 0 END AS year, trim(invoice_no) AS invoice_no FROM receipts)"""
_REASONS = f"""concat_ws('; ', CASE WHEN vendor = '' THEN 'missing vendor' END, CASE WHEN total IS NULL THEN 'missing or unparseable total' END,
    CASE WHEN check_sum AND abs(total - item_sum) > 0.01 THEN printf('total %.2f != sum(line items) %.2f', total, item_sum) END,
    CASE WHEN date_iso = '' THEN 'missing date' WHEN date_iso > '{TODAY}' THEN 'future-dated (' || date_iso || ')'
    WHEN year < 2023 THEN 'stale date (' || date_iso || ', before 2023)' END,
    CASE WHEN currency = '' THEN 'missing currency' WHEN currency <> 'USD' THEN 'non-USD currency (' || currency || ')' END,
    CASE WHEN total > 500 THEN printf('total %.2f exceeds policy cap 500.00', total) END)"""
_WHY = f"""concat_ws('; ', CASE WHEN vendor = '' THEN 'missing vendor' END, CASE WHEN total IS NULL THEN 'missing/unparseable total' END,
    CASE WHEN check_sum AND abs(total - item_sum) > 0.01 THEN 'total != sum(line items)' END,
    CASE WHEN total > 500 THEN 'total exceeds cap 500.0' END,
    CASE WHEN currency = '' THEN 'missing currency' WHEN currency <> 'USD' THEN 'non-USD currency (' || currency || ')' END,
    CASE WHEN date_iso = '' THEN 'missing/unparseable date' WHEN date_iso > '{TODAY}' THEN 'future-dated (' || date_iso || ')' END,
    CASE WHEN year <> 0 AND (year < 2023 OR year > 2099) THEN 'date year out of range (' || date_iso || ')' END,
    CASE WHEN n_same > 1 THEN 'duplicate invoice number (' || invoice_no || ')' END)"""
_JUDGED = f"judged AS (SELECT *, {_REASONS} AS reasons FROM typed)"
_COUNTED = """counted AS (SELECT *, CASE WHEN invoice_no = '' THEN 1 ELSE count(*) OVER (PARTITION BY invoice_no) END AS n_same FROM judged)"""
_DUP = "CASE WHEN n_same > 1 THEN 'duplicate invoice number (' || invoice_no || ')' END"
_NO_VERDICT = "CAST(substr(source_file, 2, length(source_file) - 5) AS BIGINT) % 89 = 0"
_FINAL = f"""final AS (SELECT source_file, concat_ws('; ', CASE WHEN {_NO_VERDICT} THEN 'validator produced no outcome' ELSE nullif(reasons, '') END, {_DUP}) AS reasons FROM counted)"""


def records(t):
    """Raw receipt records with line items."""
    item = lambda name: F.struct(F.lit(name).alias("name"), F.col(name).alias("amount"))
    return t.receipts.select(
        "source_file", "vendor", F.col("date_iso").alias("date"), "currency", "total", "invoice_no",
        F.array(item("goods"), item("fee")).alias("line_items"),
    )


def _number():
    return F.regexp_extract("source_file", r"(\d+)", 1).cast("bigint")


def _verdicts(t):
    """Per-receipt verdicts; the judge forgot every 89th receipt."""
    judged = ledger.receipt_rules(ledger.gate_inputs(records(t)), TODAY)
    return judged.where(_number() % 89 != 0).select("source_file", "outcome", "reasons")


def _final(t):
    return ledger.apply_uniqueness(t.receipts.select("source_file", "invoice_no"), _verdicts(t))


@query("gate_inputs", f"WITH {_TYPED} SELECT source_file, vendor, currency, total, check_sum, round(item_sum, 4) AS item_sum, date_iso, year, invoice_no FROM typed")
def _(t):
    return ledger.gate_inputs(records(t)).drop("date_raw").withColumn("item_sum", F.round("item_sum", 4))


@query(
    "receipt_rules",
    f"WITH {_TYPED}, {_JUDGED} SELECT source_file, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reasons FROM judged",
)
def _(t):
    return ledger.receipt_rules(ledger.gate_inputs(records(t)), TODAY).select("source_file", "outcome", joined_reasons())


def joined_reasons(column: str = "reasons"):
    return F.array_join(column, "; ").alias(column)


@query(
    "missing_fields",
    """SELECT source_file, missing FROM (SELECT source_file, concat_ws(',', CASE WHEN trim(vendor) = '' THEN 'vendor' END,
    CASE WHEN trim(date_iso) = '' THEN 'date' END, CASE WHEN trim(total) = '' THEN 'total' END,
    CASE WHEN trim(currency) = '' THEN 'currency' END) AS missing FROM receipts) WHERE missing <> ''""",
)
def _(t):
    return ledger.missing_fields(records(t)).select("source_file", joined_list("missing", "missing"))


@query(
    "apply_uniqueness",
    f"""WITH {_TYPED}, {_JUDGED}, {_COUNTED}, {_FINAL}
    SELECT source_file, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reasons FROM final""",
)
def _(t):
    return _final(t).select("source_file", "outcome", joined_reasons())


@query(
    "triage",
    """WITH h AS (SELECT *, min(file) OVER (PARTITION BY sha256(content)) AS survivor FROM inbox)
    SELECT file, CASE WHEN survivor <> file THEN 'exact duplicate of ' || survivor WHEN NOT readable THEN 'corrupt / unreadable file'
    WHEN NOT is_receipt THEN 'not a receipt' END AS reason FROM h""",
)
def _(t):
    hashed = t.inbox.select("file", F.sha2("content", 256).alias("digest"), "readable", "is_receipt")
    return ledger.triage(persist_to_shared(hashed, "digests"))


_OUT = f"""outcomes AS (SELECT source_file, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reasons AS reason, 3 AS phase FROM final)"""


def _outcomes(t):
    return _final(t).select("source_file", "outcome", F.lit(3).alias("phase"), F.array_join("reasons", "; ").alias("reason"))


_KEY = "CAST(substr(source_file, 2, length(source_file) - 5) AS BIGINT)"


@query(
    "audit_accounting",
    f"""WITH {_TYPED}, {_JUDGED}, {_COUNTED}, {_FINAL}, {_OUT}, k AS (SELECT *, {_KEY} AS k FROM outcomes)
    SELECT 'unaccounted' AS problem, 1 AS phase, source_file FROM k WHERE k % 101 = 0
    UNION ALL SELECT 'unexpected', 1, 'ghost-' || source_file FROM k WHERE k % 103 = 0 AND k % 101 <> 0
    UNION ALL SELECT 'double-counted', 1, source_file FROM k WHERE k % 107 = 0 AND k % 101 <> 0
    UNION ALL SELECT 'accepted with a reason', 3, source_file FROM k WHERE k % 101 <> 0 AND k % 109 = 0""",
)
def _(t):
    n = _number()
    stored = persist_to_shared(_outcomes(t), "outcomes")  # a run's decisions are a table of their own
    done = stored.where(n % 101 != 0)
    done = done.withColumns(
        {
            "outcome": F.when(n % 109 == 0, "accepted").otherwise(F.col("outcome")),
            "reason": F.when(n % 109 == 0, "late reason").otherwise(F.col("reason")),
        }
    )
    twice = done.where(n % 107 == 0).withColumns({"outcome": F.lit("dropped"), "reason": F.lit("again")})
    ghost = done.where(n % 103 == 0).withColumns(
        {"source_file": F.concat(F.lit("ghost-"), "source_file"), "outcome": F.lit("dropped"), "reason": F.lit("?")}
    )
    return ledger.accounting(t.receipts, done.unionByName(twice).unionByName(ghost))


@query(
    "gate_recheck",
    f"""WITH {_TYPED}, {_JUDGED}, {_COUNTED} SELECT source_file, why FROM (SELECT source_file, {_WHY} AS why FROM counted)
    WHERE {_KEY} % 2 = 0 AND why <> ''""",
)
def _(t):
    typed = persist_to_shared(ledger.gate_inputs(records(t)), "typed")  # parsed once
    # a careless judge accepted every second receipt
    decided = typed.select("source_file", F.when(_number() % 2 == 0, "accepted").otherwise("rejected").alias("decided"))
    return ledger.recheck(typed, decided, TODAY).select("source_file", joined_reasons("why"))


@query(
    "gate_recount",
    f"SELECT count(*) FILTER (WHERE {_KEY} % 2 = 0) AS accepted FROM receipts",
)
def _(t):
    decided = t.receipts.select(F.when(_number() % 2 == 0, "accepted").otherwise("rejected").alias("decided"))
    right = decided.where("decided = 'accepted'").count()
    return ledger.count_mismatch(decided, reported=-1).unionByName(ledger.count_mismatch(decided, reported=right))


@query(
    "ledger_split",
    f"""WITH {_TYPED}, {_JUDGED}, {_COUNTED}, {_FINAL}, {_OUT}
    SELECT 'ledger' AS part, source_file, 'accepted' AS outcome, phase, '' AS reason FROM outcomes WHERE outcome = 'accepted'
    UNION ALL SELECT 'rejects', source_file, outcome, phase, reason FROM outcomes WHERE outcome <> 'accepted'""",
)
def _(t):
    accepted, rejects = ledger.split_ledger(_outcomes(t))
    cols = ["source_file", "outcome", "phase", "reason"]
    return accepted.select(F.lit("ledger").alias("part"), *cols).unionByName(rejects.select(F.lit("rejects").alias("part"), *cols))


@query(
    "ledger_rows",
    f"""WITH {_TYPED}, {_JUDGED}, {_COUNTED}, {_FINAL}, {_OUT}
    SELECT r.source_file, r.vendor, r.invoice_no, r.date_iso AS date, upper(r.currency) AS currency,
    printf('%.2f', {_NUM.format('r.total')}) AS total, 2 AS num_items
    FROM receipts r JOIN outcomes o ON o.source_file = r.source_file WHERE outcome = 'accepted'""",
)
def _(t):
    accepted, _rejects = ledger.split_ledger(_outcomes(t))
    return ledger.ledger_rows(accepted, records(t))
