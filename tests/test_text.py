import html
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as X
from threadloom.functions import times, vectors
from threadloom.operators.cleaning import with_clean_text

CASES = [
    None,
    "",
    "   ",
    "plain",
    "**bold** and *italic* and ~~gone~~ and `code`",
    "***both***",
    "****",
    "* a list\n* of two",
    "**over\nlines**",
    "[text](http://example.org/a?b=1) after",
    "[a](b [c](d) e)",
    "[x]\n(y)",
    "see http://a.example/b, httpabc and https://c d",
    "tabs\tstay\there",
    "a\n\n\nb   c",
    "  nbsp  ",
    "line sep *x y* z",
    "&lt;b&gt; &amp;amp; &#65; &#x42; &nbsp; &copy no semicolon &unknown;",
    "&ast;&ast;bold&ast;&ast;",
    "`a*b`*c",
    "café \U0001f600 ~~\U0001f600~~",
    "\x1c\x1d separators \x85",
]


def expected(text):
    """The steps on one string, with Python's own string tools."""
    out = html.unescape(text or "")
    for _, pattern in X.INLINE_MARKUP:
        out = re.compile(pattern).sub(lambda m: m.group(1), out)
    out = re.compile(r"http\S+").sub("", out)
    spaced = " ".join(out.split("\n"))
    while "  " in spaced:
        spaced = spaced.replace("  ", " ")
    return spaced.strip()


def test_clean_text_on_hard_strings(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "n int, s string")
    by_column = df.select("n", X.clean_text(F.col("s")).alias("c")).collect()
    by_frame = with_clean_text(df, "s", "c").select("n", "c").collect()
    want = {n: expected(s) for n, s in enumerate(CASES)}
    assert {r.n: r.c for r in by_column} == want
    assert {r.n: r.c for r in by_frame} == want


@pytest.mark.parametrize(
    "name, column", [("documents", "text"), ("conversations", "text"), ("pages", "html")]
)
def test_clean_text_on_tables(spark, name, column):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(column)
    for row in with_clean_text(df, column, "c").collect():
        assert row.c == expected(row[column])


def test_clean_text_is_computed_once_below_a_filter(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("s"))
    plan = with_clean_text(df, "s", "c").where("c <> ''")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("http[^") == 1


def test_quality_predicates(spark):
    texts = [None, "", " [deleted] ", "[removed]", "x" * 29, " " + "x" * 29 + " ", "x" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, s string").orderBy("n")
    low = [r[0] for r in df.select(X.is_low_quality(F.col("s"))).collect()]
    removed = [r[0] for r in df.select(X.is_removed(F.col("s"))).collect()]
    non_empty = [r[0] for r in df.select(X.is_non_empty(F.col("s"))).collect()]
    assert low == [True] * 6 + [False]
    assert removed == [True] * 4 + [False] * 3
    assert non_empty == [False, False] + [True] * 5


def test_split_list(spark):
    df = spark.createDataFrame([(" a, b,,c ,",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(X.split_list(F.col("s"))).collect()]
    assert got == [["a", "b", "c"], [], []]


def test_epoch_and_utc_text(spark):
    df = spark.createDataFrame([(0.4,), (1.5,), (1700000000.0,), (None,)], "e double")
    got = [r[0] for r in df.select(times.epoch_to_ntz(F.col("e"))).collect()]
    assert got == [
        datetime(1970, 1, 1),
        datetime(1970, 1, 1, 0, 0, 2),
        datetime(2023, 11, 14, 22, 13, 20),
        None,
    ]
    text = spark.createDataFrame([("2024-02-29T01:02:03Z",), ("bad",), (None,)], "s string")
    parsed = text.select(times.parse_utc(F.col("s")).alias("t"))
    back = [r[0] for r in parsed.select(times.format_utc(F.col("t"))).collect()]
    assert back == ["2024-02-29T01:02:03Z", None, None]


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(times.epoch_to_ntz(F.lit(3600.0)).alias("t")).first()
        assert row.t == datetime(1970, 1, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_staleness_and_label(spark):
    as_of = datetime(2024, 1, 10, 12)
    rows = [
        (None, True, "Never ingested"),
        (datetime(2024, 1, 10, 12, 5), False, "Last updated: just now"),
        (datetime(2024, 1, 10, 11, 59, 1), False, "Last updated: just now"),
        (datetime(2024, 1, 10, 11, 59), False, "Last updated: 1 minute ago"),
        (datetime(2024, 1, 10, 11, 0, 1), False, "Last updated: 59 minutes ago"),
        (datetime(2024, 1, 10, 11), False, "Last updated: 1 hour ago"),
        (datetime(2024, 1, 10, 6), False, "Last updated: 6 hours ago"),
        (datetime(2024, 1, 10, 5, 59, 59), True, "Last updated: 6 hours ago"),
        (datetime(2024, 1, 9, 12), True, "Last updated: 1 day ago"),
        (datetime(2024, 1, 1), True, "Last updated: 9 days ago"),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "n int, t timestamp_ntz")
    got = df.orderBy("n").select(
        times.is_stale(F.col("t"), as_of), times.freshness_label(F.col("t"), as_of)
    )
    assert [tuple(r) for r in got.collect()] == [r[1:] for r in rows]


def test_cosine(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])],
        "a array<float>, b array<float>",
    )
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 0.0]
