from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from threadloom.operators import context, incremental, joins, quality, ranking
from threadloom.operators.dedupe import dedupe_records, latest_by_key, latest_of_repeated, merge_by_key
from threadloom.operators.joins import hot_keys, left_join_one_to_many, not_known


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_dedupe_keeps_the_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "old"), ("a", 2.0, "y"), ("a", 2.0, "x"), ("b", None, "n"), (None, 1.0, "z")],
        "id string, created_utc double, v string",
    )
    assert bag(dedupe_records(df)) == Counter([("a", 2.0, "x"), ("b", None, "n"), (None, 1.0, "z")])


def test_dedupe_cuts_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_by_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_dedupe_with_a_map_column(spark):
    df = spark.createDataFrame(
        [("a", 1, {"k": "v"}), ("a", 2, {})], "id string, n int, m map<string,string>"
    )
    rows = latest_by_key(df, ["id"], [F.col("n").desc()]).collect()
    assert [(r.id, r.n, r.m) for r in rows] == [("a", 2, {})]


def test_merge_by_key(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "id string, t int, v string")
    new = spark.createDataFrame([("b", 2, "y"), ("c", 2, "y")], "id string, t int, v string")
    got = merge_by_key(old, new, ["id"], [F.col("t").desc()])
    assert bag(got) == Counter([("a", 1, "x"), ("b", 2, "y"), ("c", 2, "y")])


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 50, 7, 1])
def test_left_join_gives_the_same_rows_however_it_is_spread(spark, hot_rows):
    left = spark.createDataFrame(
        [(k, f"l{n}") for n, k in enumerate([0, 0, 1, 2, 3, 99, None])], "k int, l string"
    )
    # Key 0 holds a third of the rows, key 99 none; null keys never match.
    right = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 4).cast("int"))
        .alias("rk"),
        F.col("id").alias("r"),
    )
    plain = left.join(right, F.col("k") == F.col("rk"), "left")
    spread = left_join_one_to_many(left, right, "k", "rk", ["r"], hot_rows)
    assert spread.columns == ["k", "l", "rk", "r"]
    assert bag(spread) == bag(plain)
    # Counted on rows that are not all on the right side: key 0 is hot there, gone here.
    fewer = right.where("rk <> 0")
    counted_raw = left_join_one_to_many(
        left, fewer, "k", "rk", ["r"], hot_rows, count_from=right
    )
    assert bag(counted_raw) == bag(left.join(fewer, F.col("k") == F.col("rk"), "left"))


def test_a_hot_key_of_compressible_rows_is_spread_by_default(spark, tmp_path, monkeypatch):
    """A third of the rows on one key, in files that say nothing of the rows' size."""
    monkeypatch.setattr(left_join_one_to_many, "__defaults__", (1000, None))
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("rk"),
        F.repeat(F.lit("x"), 500).alias("body"),
        F.col("id").alias("r"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    left = spark.range(9000).select(F.col("id").alias("k"))
    right = spark.read.parquet(str(tmp_path / "rows"))
    joined = left_join_one_to_many(left, right, "k", "rk", ["r"])
    assert "_share" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.where("k = 0").count() == 3000 and joined.count() == 9000 + 2999


def test_a_long_list_of_hot_keys_stays_a_frame(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_LISTED_KEYS", 3)
    left = spark.range(10).select(F.col("id").alias("k"))
    right = spark.range(100).select((F.col("id") % 8).alias("rk"), F.col("id").alias("r"))
    joined = left_join_one_to_many(left, right, "k", "rk", ["r"], 5)
    assert bag(joined) == bag(left.join(right, F.col("k") == F.col("rk"), "left"))


def test_hot_keys(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(None,)] * 9, "k int")
    assert [tuple(r) for r in hot_keys(df, "k", 2).collect()] == [(1, 3)]


def test_not_known(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    known = spark.createDataFrame([("b",), ("b",), ("z",)], "id string")
    assert bag(not_known(df, known, "id")) == Counter([("a",), ("c",)])


def test_watermark_is_strict_and_set_based(spark):
    posts = spark.createDataFrame(
        [("f", 30.0), ("f", 10.0), ("f", 20.0), ("f", 21.0), ("g", 1.0)],
        "subreddit string, created_utc double",
    )
    marks = spark.createDataFrame(
        [("f", datetime(1970, 1, 1, 0, 0, 20)), ("h", datetime(1990, 1, 1))],
        "subreddit string, last_ingested_utc timestamp_ntz",
    ).withColumn("last_ingested_utc", F.col("last_ingested_utc").cast("timestamp"))
    kept = incremental.newer_than_watermark(posts, marks)
    assert bag(kept) == Counter([("f", 30.0), ("f", 21.0), ("g", 1.0)])


def test_progress_counts(spark):
    posts = spark.createDataFrame([("a", "f"), ("b", "f"), ("c", "g")], "id string, s string")
    done = spark.createDataFrame([("a",), ("a",), ("c",)], "id string")
    assert bag(incremental.progress_counts(posts, done)) == Counter([(2, 1)])
    assert bag(incremental.progress_counts(posts, done, by=["s"])) == Counter(
        [("f", 1, 1), ("g", 1, 0)]
    )


def test_quality_tests_fail_on_planted_records(spark):
    df = spark.createDataFrame(
        [("a", "t"), ("a", None), ("b", "t"), (None, "t"), (None, None)], "id string, title string"
    )
    verdicts = quality.unique(df, "id", "m").unionAll(quality.not_null(df, ["id", "title"], "m"))
    assert bag(verdicts) == Counter(
        [
            ("unique_m_id", 1, True, True),
            ("not_null_m_id", 2, True, True),
            ("not_null_m_title", 2, True, True),
        ]
    )
    clean = df.where("id = 'b'")
    passing = quality.unique(clean, "id", "m").unionAll(quality.not_null(clean, ["id"], "m"))
    assert {tuple(r)[1:] for r in passing.collect()} == {(0, False, False)}
    assert bag(quality.duplicate_keys(df, "id")) == Counter([("a", 2)])
    assert quality.null_rows(df, "id").count() == 2
    assert bag(quality.row_counts(x=df, y=clean)) == Counter([("x", 5), ("y", 1)])


def test_first_posts_follow_the_listing(spark):
    posts = spark.createDataFrame(
        [("f", 0, 1, "b"), ("f", 1, 0, "c"), ("f", 0, 0, "a"), ("g", 0, 0, "d")],
        "subreddit string, page int, position int, id string",
    )
    order = [F.col("page"), F.col("position")]
    assert {r.id for r in ranking.first_posts(posts, order, 2).collect()} == {"a", "b", "d"}
    plan = ranking.first_posts(posts, order, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "2000, Partial" in plan


def test_post_context(spark):
    mart = spark.createDataFrame(
        [
            ("p", "T", "B", "c1", 1, "low"),
            ("p", "T", "B", "c2", 9, "high"),
            ("p", "T", "B", "c3", 5, "middle"),
            ("q", "U", "C", None, None, None),
        ],
        "post_id string, post_title string, post_body string, comment_id string, "
        "comment_score int, comment_body string",
    )
    assert bag(context.post_context(mart, 2)) == Counter(
        [("p", "T\nB\nhigh\nmiddle"), ("q", "U\nC")]
    )


def test_tests_made_by_the_write(spark, tmp_path):
    rows = [(f"k{n}", n) for n in range(3000)] + [("k1", None), ("k1", 1), ("k2", None), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    for frame, want in (
        (df, {"not_null_t_k": 2, "not_null_t_v": 2, "unique_t_k": 2}),
        (df.limit(0), {"not_null_t_k": 0, "not_null_t_v": 0, "unique_t_k": 0}),
        (spark.createDataFrame([("a", 1)] * 50, df.schema), {"not_null_t_k": 0, "not_null_t_v": 0, "unique_t_k": 1}),
    ):
        written, tests = quality.write_tested(frame, str(tmp_path / "t"), "t", ["k", "v"], "k")
        assert {r["test"]: r["failures"] for r in tests.collect()} == want
        assert all(r["should_warn"] == r["should_error"] == (r["failures"] > 0) for r in tests.collect())
        assert written.exceptAll(frame).count() == 0 == frame.exceptAll(written).count()
    few = quality.suspects(df.select("k"), "k", 3005)
    assert {"k1", "k2"} <= {r["k"] for r in few.collect()} and few.count() < 200


def test_few_repeated_keys_are_deduped_alone(spark):
    rows = [(None, 1, "x"), (None, 2, "y"), ("a", 1, "x"), ("a", 1, "z"), ("b", 1, "x"), ("c", 3, "q")]
    frame = spark.createDataFrame(rows, "id string, t int, text string")
    order = [F.col("t").desc()]
    want = sorted(map(str, latest_by_key(frame, ["id"], order).collect()))
    for most in (100, 0):
        assert sorted(map(str, latest_of_repeated(frame, "id", order, most).collect())) == want
    once = latest_of_repeated(frame.where("id in ('b', 'c')"), "id", order)
    assert once.count() == 2 and "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
