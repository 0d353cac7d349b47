"""Order cleaning, the three rule phases and the repair, on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import clean, gates, rules

# Own rows: what is wrong with each stands beside it.
PAID = [
    ("p-7", "ann", "18.40", "USD", "PAID"),
    ("p-8", "bob", "77", "USD", "PAID"),
    ("p-9", "cy", "0", "USD", "PAID"),  # nothing paid
    ("p-10", "", "31.00", "USD", "PAID"),  # nobody
    ("p-11", "dee", "12.5", "GBP", "PAID"),
    ("p-12", "eve", "64.00", "USD", "REFUNDED"),
    ("p-13", "flo", "1d", "USD", "PAID"),  # no number
]
DEFECTIVE = [
    (10, "K7", "ann", "2023-05-30", "12", "USD", "pending", "home"),
    (20, "K8", "bob", "2025-11-02", "349.99", "USD", "shipped", "sports"),
    (30, "K7", "cy", "2024-06-06", "15.25", "USD", "completed", "books"),  # id of row 10
    (40, "", "dee", "2024-06-07", "20", "USD", "completed", "books"),  # no id
    (50, "K9", " ", "2024-06-08", "21", "USD", "completed", "books"),  # nobody
    (60, "K10", "eve", "2024-06-09", "2f", "USD", "completed", "books"),  # no number
    (70, "K11", "flo", "02/03/2024", "22", "USD", "completed", "books"),  # February or March
    (80, "K12", "gus", "30/09/2024", "23", "USD", "completed", "books"),  # day first, no doubt
    (90, "K13", "hal", "2024-06-11", "-3", "GBP", "completed", "books"),  # money back, other money
    (100, "K14", "ida", "2024-06-12", "24", "USD", "Pending", "HOME"),  # case only
    (110, "K15", "jon", "2024-06-13", "25", "USD", "lost", "toys"),  # neither is known
    (120, "K16", "kim", "2019-12-31", "900.5", "USD", "cancelled", "clothing"),  # old and dear
]
COLUMNS = "row_no int, order_id string, customer_id string, order_date string, amount string, currency string, status string, product_category string"


@pytest.fixture(scope="module")
def paid(spark):
    return spark.createDataFrame(PAID, "order_id string, customer_id string, amount string, currency string, status string")


@pytest.fixture(scope="module")
def defective(spark):
    return spark.createDataFrame(DEFECTIVE, COLUMNS)


def test_clean_keeps_two_orders(paid):
    assert sorted(r.order_id for r in clean.clean_orders(paid).collect()) == ["p-7", "p-8"]


def test_clean_is_idempotent(paid):
    once = clean.clean_orders(paid)
    assert clean.clean_orders(once).exceptAll(once).isEmpty() and clean.clean_orders(once).count() == once.count()


def test_quality_report(paid):
    r = clean.quality_report(paid).first()
    assert (r.rows_in, r.rows_out, r.rows_dropped) == (7, 2, 5)


def test_required_columns(paid):
    missing = gates.required_columns(paid, ["order_id", "amount", "created_at"])
    assert [r.subject for r in missing.collect()] == ["created_at"]
    assert gates.required_columns(paid, ["order_id"]).isEmpty()


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.rule, []).append(r.row_no)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_phase1(defective, hot_rows):
    assert found(rules.order_findings(defective, (1,), hot_rows)) == {
        "order_id_required": [40], "customer_id_required": [50], "amount_parseable": [60], "order_id_unique": [30],
    }


def test_phase2(defective):
    assert found(rules.order_findings(defective, (2,))) == {
        "order_date_format": [70, 80], "amount_positive": [90], "currency_usd": [90],
        "status_valid": [100, 110], "product_category_valid": [100, 110],
    }


def test_phase3(defective):
    assert found(rules.order_findings(defective, (3,))) == {"date_recency": [120], "amount_ceiling": [120]}


def test_progressive_stops_at_the_first_failing_phase(defective):
    assert {r.phase for r in rules.first_failing_phase(rules.order_findings(defective)).collect()} == {1}
    sound = defective.where("row_no NOT IN (30, 40, 50, 60)")
    assert {r.phase for r in rules.first_failing_phase(rules.order_findings(sound)).collect()} == {2}
    good = defective.where("row_no IN (10, 20)")
    assert rules.first_failing_phase(rules.order_findings(good)).isEmpty()
    assert rules.report(good).first().status == "passed"
    assert tuple(rules.report(sound).first())[:4] == ("failed", 2, "Format & Value Conformance", 8)


def test_nan_is_a_number_but_breaks_no_limit(spark):
    df = spark.createDataFrame([(1, "a", "c", "2024-1-5", "nan", "USD", "pending", "home")], COLUMNS)
    assert rules.order_findings(df).isEmpty()


def test_repair(defective):
    fixed = rules.repair_orders(defective).orderBy("row_no").collect()
    assert [r.row_no for r in fixed] == [10, 20, 80, 100]
    assert fixed[2].order_date == "2024-09-30" and (fixed[3].status, fixed[3].product_category) == ("pending", "home")
    assert rules.order_findings(rules.repair_orders(defective)).isEmpty()


def test_repair_converts_unambiguous_dates_only(spark):
    days = {"12/25/2024": "2024-12-25", "25/12/2024": "2024-12-25", "7/7/2024": "2024-07-07", "4/5/2024": None}
    df = spark.createDataFrame([(i, f"k{i}", "c", d, "5", "usd", "pending", "home") for i, d in enumerate(days)], COLUMNS)
    got = {r.row_no: r.order_date for r in rules.repair_orders(df).collect()}
    assert got == {i: d for i, d in enumerate(days.values()) if d}


def test_summary_blocks_hold_all_rows(spark):
    many = spark.range(5000).select(F.lit(1).alias("phase"), F.lit("r").alias("rule"), F.col("id").alias("row_no"))
    out = rules.rule_summary(many, block_rows=100).collect()
    assert len(out) == 50 and max(len(r.affected_rows) for r in out) == 100
    assert sorted(x for r in out for x in r.affected_rows) == list(range(5000))
