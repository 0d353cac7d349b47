"""Receipt rules, uniqueness, accounting and gate inputs."""

import pytest

from tablewright.functions.dates import parse_date, to_iso_date
from tablewright.functions.numbers import parse_amount
from tablewright.operators import ledger
from pyspark.sql import functions as F

TODAY = "2025-09-30"
RECORD = "source_file string, vendor string, date string, currency string, total string, invoice_no string, line_items array<struct<name:string,amount:string>>"
GOOD = {
    "source_file": "till-4.jpg", "vendor": "Corner Bakery", "date": "2025-02-03", "currency": "USD", "total": "10.00", "invoice_no": "B/77",
    "line_items": [("bread", "3.20"), ("jam", "6.80")],
}


def receipts(spark, *changes):
    rows = [tuple({**GOOD, **c}[k] for k in GOOD) for c in changes]
    return spark.createDataFrame(rows, RECORD)


def verdict(spark, **change):
    return ledger.receipt_rules(ledger.gate_inputs(receipts(spark, change)), TODAY).first()


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"total": "12.00"}, "total 12.00 != sum(line items) 10.00"),
        ({"date": "2027-08-01"}, "future-dated (2027-08-01)"),
        ({"date": "2019-01-01"}, "stale date (2019-01-01, before 2023)"),
        ({"date": ""}, "missing date"),
        ({"date": "not a date"}, "unparseable date ('not a date')"),
        ({"currency": "EUR"}, "non-USD currency (EUR)"),
        ({"currency": " usd "}, None),
        ({"currency": None}, "missing currency"),
        ({"vendor": "  "}, "missing vendor"),
        ({"total": "n/a"}, "missing or unparseable total"),
        ({"total": "$600.00", "line_items": [("suite", "600.0")]}, "total 600.00 exceeds policy cap 500.00"),
        ({"total": "$10.00", "line_items": []}, None),
        ({"line_items": [("x", "free"), ("y", "6.00")]}, None),  # an unreadable item skips the sum rule
    ],
)
def test_rules(spark, change, reason):
    v = verdict(spark, **change)
    assert v.reasons == ([] if reason is None else [reason])
    assert v.outcome == ("accepted" if reason is None else "rejected")


def final(spark, drafts, verdicts, hot_rows=1_000_000):
    d = spark.createDataFrame(drafts, "source_file string, invoice_no string")
    v = spark.createDataFrame(verdicts, "source_file string, outcome string, reasons array<string>")
    return {r.source_file: (r.outcome, r.reasons) for r in ledger.apply_uniqueness(d, v, hot_rows).collect()}


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_uniqueness_rejects_every_bearer(spark, hot_rows):
    out = final(
        spark, [("a", "DUP"), ("b", "DUP"), ("c", "UNIQ"), ("d", " "), ("e", "")],
        [(f, "accepted", []) for f in "abcde"], hot_rows,
    )
    assert {f for f, (o, _) in out.items() if o == "accepted"} == {"c", "d", "e"}
    assert out["a"][1] == ["duplicate invoice number (DUP)"]


def test_uniqueness_keeps_reasons_and_rejects_the_undecided(spark):
    out = final(spark, [("a", "X"), ("b", "Y")], [("a", "rejected", ["non-USD currency (EUR)"])])
    assert out == {"a": ("rejected", ["non-USD currency (EUR)"]), "b": ("rejected", ["validator produced no outcome"])}


def problems(spark, inbox, outcomes):
    i = spark.createDataFrame([(f,) for f in inbox], "source_file string")
    o = spark.createDataFrame(outcomes, "source_file string, outcome string, reason string")
    return sorted((r.problem, r.phase, r.source_file) for r in ledger.accounting(i, o).collect())


ACC = ("a", "accepted", "")


def test_accounting(spark):
    assert problems(spark, "abc", [ACC, ("b", "rejected", "x"), ("c", "dropped", "y")]) == []
    assert problems(spark, "ab", [ACC]) == [("unaccounted", 1, "b")]
    assert problems(spark, "a", [ACC, ("a", "dropped", "dup")]) == [("double-counted", 1, "a")]
    assert problems(spark, "a", [("a", "accepted", "bad")]) == [("accepted with a reason", 3, "a")]
    assert problems(spark, "a", [("a", "dropped", "bad")]) == [("nothing accepted", 2, None)]
    assert problems(spark, "a", [ACC, ("ghost", "accepted", "")]) == [("unexpected", 1, "ghost")]


def test_gate_inputs_are_typed(spark):
    g = ledger.gate_inputs(receipts(spark, {"date": "1/20/2026", "currency": "usd", "total": "$10.00"})).first()
    assert (g.currency, g.total, g.date_iso, g.year, g.check_sum, g.item_sum) == ("USD", 10.0, "2026-01-20", 2026, True, 10.0)
    g = ledger.gate_inputs(receipts(spark, {"total": "N/A", "line_items": []})).first()
    assert g.total is None and g.check_sum is False


def test_recheck_blocks_only_wrong_acceptance(spark):
    typed = ledger.gate_inputs(receipts(spark, {"source_file": "a"}, {"source_file": "b", "currency": "EUR", "invoice_no": "B"}))
    both = spark.createDataFrame([("a", "accepted"), ("b", "accepted")], "source_file string, decided string")
    assert [r.source_file for r in ledger.recheck(typed, both, TODAY).collect()] == ["b"]
    harsh = spark.createDataFrame([("a", "rejected"), ("b", "rejected")], "source_file string, decided string")
    assert ledger.recheck(typed, harsh, TODAY).isEmpty()
    assert ledger.count_mismatch(both, 2).isEmpty() and not ledger.count_mismatch(both, 1).isEmpty()


def test_triage_first_reason_wins(spark):
    rows = [("a", "h1", True, True), ("b", "h1", False, True), ("c", "h2", False, False), ("d", "h3", True, False), ("e", "h4", True, True)]
    inbox = spark.createDataFrame(rows, "file string, digest string, readable boolean, is_receipt boolean")
    for hot_rows in (1_000_000, 2):
        got = {r.file: r.reason for r in ledger.triage(inbox, hot_rows).collect()}
        assert got == {
            "a": None, "b": "exact duplicate of a", "c": "corrupt / unreadable file", "d": "not a receipt", "e": None,
        }


def test_dates(spark):
    cases = {
        "2026-03-12": "2026-03-12", "1/20/2026": "2026-01-20", "2026/3/9": "2026-03-09", "Mar 9, 2026": "2026-03-09",
        "9 Mar 2026": "2026-03-09", "27JUN1974": "1974-06-27", " 2026-01-02 ": "2026-01-02", "": "", "not a date": "",
        "2024-13-01": "", "2/30/2024": "", None: "", "August 7, 2025": "2025-08-07", "Aug 7 2025": "2025-08-07",
        "7 August 2025": "2025-08-07", "19/04/2025": "2025-04-19", "2025.04.19": "2025-04-19",
        "2025-04-19T08:30:00": "2025-04-19", "2025-04-19 08:30": "2025-04-19", "Augusta 7, 2025": "", "Sept. 2, 2025": "2025-09-02",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    for r in df.select("raw", "want", F.expr(to_iso_date("raw")).alias("got"), F.expr(parse_date("raw")).alias("d")).collect():
        assert r.got == r.want, r


def test_amounts(spark):
    df = spark.createDataFrame([("$1,234.50",), (" 7 ",), ("n/a",), (None,), ("1e3",), ("1d",), ("0x1p3",), (".5",)], "raw string")
    assert [r[0] for r in df.select(F.expr(parse_amount("raw"))).collect()] == [1234.5, 7.0, None, None, 1000.0, None, None, 0.5]
