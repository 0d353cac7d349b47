"""Lists over time: intervals, matching and verdicts."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tablewright.llm import url_lists

DAY = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)


def entries(spark, rows):
    return spark.createDataFrame(rows, "list string, pattern string, day date, op string")


@pytest.mark.parametrize(
    "url, host, folder",
    [
        ("https://user:pw@Sub.Example.com:8080/a/b?x#y", "sub.example.com", "a"), ("//example.org./x", "example.org", ""),
        ("http://example.org?x=/y/", "example.org", ""), ("mailto:a@b.c", None, ""), ("", None, ""), (None, None, ""), ("http:///x/", None, "x"),
        ("HTTP://EXAMPLE.ORG", "example.org", ""),
    ],
)
def test_hosts(spark, url, host, folder):
    r = spark.createDataFrame([(url,)], "u string").select(url_lists.host(F.col("u")).alias("h"), url_lists.folder(F.col("u")).alias("f")).first()
    assert r.h == host and (host is None or r.f == folder)


def test_intervals(spark):
    rows = [("l", "p", DAY(3), "add"), ("l", "p", DAY(5), "add"), ("l", "p", DAY(9), "remove"), ("l", "p", DAY(20), "add"), ("l", "q", DAY(2), "remove"),
            ("l", "r", DAY(1), "add"), ("l", "r", DAY(1), "remove"), ("l", None, DAY(1), "add"), ("l", "p", None, "add"), ("l", "s", DAY(1), "else")]
    got = {(r.pattern, r.since, str(r.until)) for r in url_lists.intervals(entries(spark, rows)).collect()}
    assert got == {("p", DAY(3), str(DAY(9))), ("p", DAY(20), "9999-12-31")}


def test_captures_meet_the_entries_of_their_day(spark):
    rnd = random.Random(2)
    patterns = ["example.com", "a.example.com", "b.example.com", "a.example.com/x/", "org"]
    rows = [(rnd.choice(["block", "allow", "spam"]), rnd.choice(patterns), DAY(rnd.randrange(30)), rnd.choice(["add", "remove"])) for _ in range(60)]
    caps = [(i, f"http://{rnd.choice(['', 'a.', 'b.', 'c.a.'])}example.com/{rnd.choice(['', 'x/', 'x', 'y/z/'])}", DAY(rnd.randrange(35))) for i in range(300)]

    def active(lst, pattern, day):
        state = False
        for d in sorted({r[2] for r in rows if r[:2] == (lst, pattern) and r[2] <= day}):
            state = "remove" not in {r[3] for r in rows if r[:3] == (lst, pattern, d)}
        return state

    got = {r.page: r for r in url_lists.judge(spark.createDataFrame(caps, "page int, url string, fetched date"), entries(spark, rows)).collect()}
    for i, url, day in caps:
        host, _, path = url[7:].partition("/")
        names = [host.split(".", k)[-1] for k in range(host.count("."))] + ([f"{host}/{path.split('/')[0]}/"] if "/" in path else [])
        hits = [(-len(p), lst, p) for p in names for lst in ("allow", "block", "spam") if active(lst, p, day)]
        best = min(hits, default=None)
        assert (got[i].pattern, got[i].list, got[i].blocked) == ((best[2], best[1], best[1] != "allow") if best else (None, None, False)), (url, day)
