"""Staging, mart, join, dedupe, ranking, quality and sink queries."""

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.catalog.registry import query, table
from threadloom.catalog.roles import COMMENTS_SQL, POSTS_SQL, STAGED_CTES, comments, posts
from threadloom.operators import context, known, quality, ranking
from threadloom.operators.dedupe import MAX_LISTED_KEYS, latest_by_key
from threadloom.operators.joins import left_join_one_to_many, not_known
from threadloom.plans import transform
from threadloom.session import stored, work_dir
from threadloom.sinks import clustered
from threadloom.sinks import tables as sinks
from threadloom.sources import files, tables


def staged_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.stage_posts(transform.transform_posts(posts(spark, sf_dir)))


def staged_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.stage_comments(transform.transform_comments(comments(spark, sf_dir)))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.build_mart(
        staged_posts(spark, sf_dir),
        staged_comments(spark, sf_dir),
        raw_comments=comments(spark, sf_dir),
    )


def stored_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged posts, staged comments and the mart, each text cleaned once."""
    stg_posts = stored(staged_posts(spark, sf_dir), "stg-posts")
    stg_comments = stored(staged_comments(spark, sf_dir), "stg-comments")
    return stg_posts, stg_comments, transform.build_mart(stg_posts, stg_comments)


@query(f"with {STAGED_CTES} select * from fct_posts")
def fct_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir)


@query(f"with {STAGED_CTES} select * from stg_posts")
def stg_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_posts(spark, sf_dir)


@query(f"with {STAGED_CTES} select * from stg_comments")
def stg_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_comments(spark, sf_dir)


@query(
    f"""with {STAGED_CTES}
    select subreddit, count(*) as n_rows, count(distinct post_id) as n_posts,
      count(comment_id) as n_comments
    from fct_posts group by subreddit"""
)
def mart_sql_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded tables -> staging views -> mart, read back by a SQL query over the models."""
    loaded = {
        "stg_posts": transform.transform_posts(posts(spark, sf_dir)),
        "stg_comments": transform.transform_comments(comments(spark, sf_dir)),
    }
    models = transform.build_models(
        {k: sinks.with_ingested_at(v, datetime(2024, 1, 1)) for k, v in loaded.items()}
    )
    return tables.read_query(
        spark,
        """select subreddit, count(*) as n_rows, count(distinct post_id) as n_posts,
             count(comment_id) as n_comments
           from {mart} group by subreddit""",
        mart=models["fct_posts"],
    )


@query(
    f"""with {STAGED_CTES}
    select 'stg_posts' as model, id, body, subreddit,
      timestamp '2024-01-01 00:00:00' as ingested_at from stg_posts
    union all select 'stg_comments', id, body, subreddit, timestamp '2024-01-01 00:00:00'
      from stg_comments
    union all select 'fct_posts', post_id, comment_body, subreddit, null from fct_posts"""
)
def models_as_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models read by name: staging views with their load time, and the mart as a table."""
    loaded = {
        "stg_posts": transform.transform_posts(posts(spark, sf_dir)),
        "stg_comments": transform.transform_comments(comments(spark, sf_dir)),
    }
    # A name of its own, as the warehouse may hold the files of another session's table.
    saved = f"threadloom_fct_posts_{uuid.uuid4().hex}"
    transform.build_models(
        {k: sinks.with_ingested_at(v, datetime(2024, 1, 1)) for k, v in loaded.items()},
        mart_table=saved,
    )
    return spark.sql(
        f"""select 'stg_posts' as model, id, body, subreddit, ingested_at from stg_posts
        union all select 'stg_comments', id, body, subreddit, ingested_at from stg_comments
        union all select 'fct_posts', post_id, comment_body, subreddit, null
          from {saved}"""
    )


@query("select * from orders left join lineitem on o_orderkey = l_orderkey")
def left_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_join_one_to_many(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        "o_orderkey",
        "l_orderkey",
        spread_on=["l_partkey", "l_linenumber"],
    )


@query(
    """select n_nationkey, n_name, s_suppkey, l_orderkey, l_linenumber, l_partkey
    from nation left join (select * from supplier join lineitem on s_suppkey = l_suppkey) r
      on n_nationkey = s_nationkey"""
)
def left_join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys with very many rows each, so the hot-key path runs."""
    supplied = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "lineitem"), F.col("s_suppkey") == F.col("l_suppkey")
    )
    return left_join_one_to_many(
        table(spark, sf_dir, "nation"),
        supplied,
        "n_nationkey",
        "s_nationkey",
        spread_on=["l_orderkey", "l_partkey"],
        hot_rows=500,
    ).select("n_nationkey", "n_name", "s_suppkey", "l_orderkey", "l_linenumber", "l_partkey")


LINEITEM_TIES = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
    "l_linestatus"
)


@query(
    f"""select * from lineitem qualify row_number() over (
      partition by l_orderkey, l_linenumber order by l_shipdate desc, {LINEITEM_TIES}) = 1"""
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc()],
    )


@query("select * from documents where doc_id not in (select doc_id from labels)")
def anti_known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_known(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("select * from documents where doc_id not in (select doc_id from labels)")
def known_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by bitmaps that two runs have added to, merged, with few slots, so that hashes meet."""
    path = work_dir(spark, "known")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    for run, part in (("a", "doc_id % 2 = 0"), ("b", "doc_id % 2 = 1"), ("b", "doc_id % 2 = 1")):
        known.add_known(labels.where(part), path, "doc_id", run, 18)
    known.compact(spark, path, "all")
    return known.not_known(docs, known.read_bitmaps(spark, path), labels, "doc_id", 18)


@query(
    """select l_orderkey as unique_field, count(*) as n_records from lineitem
    where l_orderkey is not null group by l_orderkey having count(*) > 1"""
)
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    """with f as (
      select 'unique_lineitem_l_orderkey' as test, count(*) as failures from (
        select l_orderkey from lineitem group by l_orderkey having count(*) > 1)
      union all select 'unique_orders_o_orderkey', count(*) from (
        select o_orderkey from orders group by o_orderkey having count(*) > 1))
    select test, failures, failures <> 0 as should_warn, failures <> 0 as should_error from f"""
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem")
    return lineitem.unionAll(
        quality.unique(table(spark, sf_dir, "orders"), "o_orderkey", "orders")
    )


@query(
    """with j as (select * from orders left join lineitem on o_orderkey = l_orderkey),
    f as (
      select 'not_null_orders_lines_o_orderkey' as test, count(*) as failures
        from j where o_orderkey is null
      union all select 'not_null_orders_lines_l_orderkey', count(*)
        from j where l_orderkey is null)
    select test, failures, failures <> 0 as should_warn, failures <> 0 as should_error from f"""
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = left_join_fanout(spark, sf_dir)
    return quality.not_null(joined, ["o_orderkey", "l_orderkey"], "orders_lines")


def _dq_sql(test: str, failing: str) -> str:
    return f"select '{test}' as test, (select count(*) from ({failing})) as failures"


DQ_SQL = f"""with {STAGED_CTES}, f as (
      {_dq_sql("unique_stg_posts_id", "select id from stg_posts group by id having count(*) > 1")}
      union all
      {_dq_sql("not_null_stg_posts_id", "select id from stg_posts where id is null")}
      union all {_dq_sql(
        "unique_stg_comments_id",
        "select id from stg_comments group by id having count(*) > 1",
    )}
      union all
      {_dq_sql("not_null_stg_comments_id", "select id from stg_comments where id is null")}
      union all {_dq_sql(
        "not_null_fct_posts_post_id", "select post_id from fct_posts where post_id is null"
    )}
      union all {_dq_sql(
        "not_null_fct_posts_post_title",
        "select post_title from fct_posts where post_title is null",
    )})
    select test, failures, failures <> 0 as should_warn, failures <> 0 as should_error from f"""


@query(DQ_SQL)
def dq_model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.model_tests(*stored_models(spark, sf_dir))


@query(DQ_SQL)
def dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tests, made by the writes of the models."""
    root = work_dir(spark, "tested")
    written = {}
    tests = []
    for name, frame in (("stg_posts", staged_posts(spark, sf_dir)), ("stg_comments", staged_comments(spark, sf_dir))):
        written[name], verdicts = quality.write_tested(frame, f"{root}/{name}", name, ["id"], "id")
        tests.append(verdicts)
    joined = transform.build_mart(written["stg_posts"], written["stg_comments"])
    tests.append(quality.write_tested(joined, f"{root}/fct_posts", "fct_posts", ["post_id", "post_title"])[1])
    return tests[0].unionAll(tests[1]).unionAll(tests[2])


@query(
    f"""with {STAGED_CTES}
    select 'stg_posts' as name, (select count(*) from stg_posts) as n_rows
    union all select 'stg_comments', (select count(*) from stg_comments)
    union all select 'fct_posts', (select count(*) from fct_posts)"""
)
def output_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("stg_posts", "stg_comments", "fct_posts")
    return quality.row_counts(**dict(zip(names, stored_models(spark, sf_dir), strict=True)))


@query(
    """select event_id, event_type, value + case when event_id % 3 = 0 then 1 else 0 end as value,
      cast(ts as date) as date from events"""
)
def merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, then a later copy of every third, folded in twice."""
    path = work_dir(spark, "merged")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.to_date("ts").alias("date"))
    changed = events.where("event_id % 3 = 0").withColumn("value", F.col("value") + 1)
    for rows in (events, changed, changed):
        sinks.merge_partitions(rows, path, ["event_id"], ["event_type", "date"], [F.col("value").desc()])
    return files.read_parquet(spark, path)


def land_arrays(raw: DataFrame, path: str, rows: int = 200) -> None:
    """JSON arrays of about so many records, a compressed file each, below a folder per forum."""
    counts = stored(raw.groupBy(F.col("subreddit").alias("forum")).agg(F.ceil(F.count("*") / rows).alias("blocks")), "forums")
    if counts.count() <= MAX_LISTED_KEYS:
        counts = F.broadcast(counts)  # spares the shuffle of the texts
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = raw.join(counts, F.col("subreddit").eqNullSafe(F.col("forum"))).select(
        "forum", block.alias("block"), F.struct(*raw.columns).alias("record")
    )
    arrays = dealt.groupBy("forum", "block").agg(F.to_json(F.collect_list("record")).alias("value"))
    arrays.write.partitionBy("forum", "block").text(path, compression="gzip")  # one task reads a file in any case


@query(f"with {STAGED_CTES} select {', '.join(schemas.PROCESSED_POST.names)} from clean_posts")
def transform_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON arrays of two runs folded in one after the other, the second twice.

    The first run holds older copies of some posts, of all forums but one.
    """
    root = work_dir(spark, "transform")
    landed = posts(spark, sf_dir)
    older = landed.where("num_comments % 2 = 0 and not (subreddit <=> 'src7')").withColumn("title", F.lit("old"))
    land_arrays(older.withColumn("created_utc", F.col("created_utc") - 10), f"{root}/raw/posts/run=a")
    land_arrays(landed, f"{root}/raw/posts/run=b")
    for run in ("a", "b", "b"):
        transform.transform_runs(spark, f"{root}/raw", f"{root}/processed", [run], multiline=True)
    return files.read_parquet(spark, f"{root}/processed/posts").select(*schemas.PROCESSED_POST.names)


@query(f"with {STAGED_CTES} select {', '.join(schemas.PROCESSED_COMMENT.names)} from clean_comments")
def transform_comment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as JSON arrays: older copies of some, then all, then a run without input."""
    root = work_dir(spark, "transform")
    landed = comments(spark, sf_dir)
    older = landed.where("score % 3 = 0").withColumn("body", F.lit("old"))
    land_arrays(older.withColumn("created_utc", F.col("created_utc") - 86400), f"{root}/raw/comments/run=a")
    land_arrays(landed, f"{root}/raw/comments/run=b", 2000)
    for runs in (["a"], ["b"], ["none"]):
        transform.transform_runs(spark, f"{root}/raw", f"{root}/processed", runs, multiline=True)
    return files.read_parquet(spark, f"{root}/processed/comments").select(*schemas.PROCESSED_COMMENT.names)


@query(
    """select * from documents
    qualify row_number() over (partition by source order by doc_id) <= 5"""
)
def first_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ranking.first_posts(docs, [F.col("doc_id")], 5, forum="source")


@query(
    f"""with {STAGED_CTES} select * from fct_posts
    order by post_id, comment_id nulls first limit 50"""
)
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("post_id"), F.col("comment_id").asc_nulls_first()]
    return ranking.ordered_limit(mart(spark, sf_dir), order)


@query(
    """select o_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
      row_number() over (partition by o_orderkey
        order by l_extendedprice desc, l_partkey, l_suppkey, l_linenumber) as rank
    from orders join lineitem on o_orderkey = l_orderkey qualify rank <= 3"""
)
def top_lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    columns = ["o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    order = [F.col("l_extendedprice").desc(), "l_partkey", "l_suppkey", "l_linenumber"]
    return ranking.first_per_group(lines.select(*columns), ["o_orderkey"], order, 3)


TOP_COMMENTS_CTE = """top_comments as (
  select post_id, comment_id, comment_body, comment_score, row_number() over (
    partition by post_id order by comment_score desc, comment_id) as rank
  from fct_posts where comment_id is not null qualify rank <= 2)"""


@query(f"with {STAGED_CTES}, {TOP_COMMENTS_CTE} select * from top_comments")
def top_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["post_id", "comment_id", "comment_body", "comment_score"]
    return ranking.top_comments(mart(spark, sf_dir).select(*columns), 2)


@query(
    f"""with {STAGED_CTES}, {TOP_COMMENTS_CTE},
    parts as (
      select distinct post_id, 0 as rank, post_title || chr(10) || post_body as text
        from fct_posts
      union all select post_id, rank, comment_body from top_comments)
    select post_id, string_agg(text, chr(10) order by rank) as context
    from parts group by post_id"""
)
def post_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.post_context(mart(spark, sf_dir), 2)


@query(
    """select conv_id, turn, role, text,
      row_number() over (partition by conv_id order by turn desc) as recency
    from conversations qualify recency <= 5"""
)
def memory_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.last_turns(table(spark, sf_dir, "conversations"))


@query(
    """select * from events where user_id between 20 and 60 and event_type = 'click'
      and ts >= timestamp '2024-01-05 00:00:00'"""
)
def clustered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written along a curve over user, type and time, then filtered by all three."""
    path = work_dir(spark, "clustered")
    clustered.write_clustered(table(spark, sf_dir, "events"), path, ["user_id", "event_type", "ts"])
    late = F.col("ts") >= F.expr("timestamp_ntz'2024-01-05 00:00:00'")
    return files.read_parquet(spark, path).where(F.col("user_id").between(20, 60) & (F.col("event_type") == "click") & late)


@query("select event_id, ts, event_type, value, cast(ts as date) as date from events")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by type and day, then every partition read back."""
    path = work_dir(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    dated = sinks.with_forum_date(events, "ts")
    sinks.write_partitioned(dated, path, ["event_type", "date"])
    return files.read_parquet(spark, path)


@query(POSTS_SQL)
def raw_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs written side by side as JSON; reading one gives its records back."""
    path = work_dir(spark, "raw-posts")
    raw = posts(spark, sf_dir)
    sinks.write_raw(raw.withColumn("score", F.lit(0).cast("bigint")), path, "first")
    return files.read_posts(spark, sinks.write_raw(raw, path, "second"))


@query(
    f"""with raw_comments as ({COMMENTS_SQL})
    select *, timestamp '2024-01-02 00:00:00' as ingested_at from raw_comments"""
)
def staging_append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is replayed the next day leaves one row per id, the last one."""
    path = work_dir(spark, "staging")
    raw = comments(spark, sf_dir)
    sinks.append_staging(raw.withColumn("body", F.lit("old")), path, datetime(2024, 1, 1))
    sinks.append_staging(raw, path, datetime(2024, 1, 2))
    return sinks.current_rows(files.read_parquet(spark, path))


@query(
    f"""with a as ({POSTS_SQL}), b as ({COMMENTS_SQL})
    select id, subreddit, title, selftext, null as body from a
    union all by name select id, subreddit, null as title, null as selftext, body from b"""
)
def union_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with different columns, one below the other."""
    both = posts(spark, sf_dir).unionByName(comments(spark, sf_dir), allowMissingColumns=True)
    return both.select("id", "subreddit", "title", "selftext", "body")
