"""Streaming queries over the events table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.catalog.registry import query, table
from threadloom.catalog.roles import STAGED_CTES, comments, posts
from threadloom.session import work_dir
from threadloom.streaming import dedupe, files, keyed, mart, watermarks


#: Rows of one landed file, and the most files a batch takes: a batch has its cost whatever it holds.
FILE_ROWS, BATCH_FILES = 200_000, 20


def land_out_of_order(spark: SparkSession, sf_dir: str, folder: str) -> tuple[T.StructType, int]:
    """The events in three parts, the newest third of the time first, with their day; those without a time come first of all.

    Returns their schema and the files of the largest part.
    """
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    bounds = ("2024-01-11", "2024-01-21")
    thirds = (
        F.col("day").isNull() | (F.col("day") >= bounds[1]),
        F.col("day") < bounds[0],
        (F.col("day") >= bounds[0]) & (F.col("day") < bounds[1]),
    )
    most = 1
    for third in thirds:
        some = events.where(third)
        parts = max(1, -(-some.count() // FILE_ROWS))
        some.repartition(parts).write.mode("append").parquet(folder)
        most = max(most, parts)
    return events.schema, most


def doubled_stream(spark: SparkSession, folder: str, schema: T.StructType, most: int) -> DataFrame:
    """The landed files, each twice in its batch. A batch takes about a part of them, up to BATCH_FILES."""
    rows = [files.stream_files(spark, folder, schema, "parquet", min(most, BATCH_FILES)) for _ in range(2)]
    return rows[0].unionAll(rows[1])


@query("select * from events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files out of time order, streamed twice in each of two runs, give one copy."""
    root = work_dir(spark, "stream-dedupe")
    schema, most = land_out_of_order(spark, sf_dir, f"{root}/landing")
    for attempt in ("first", "replay"):
        doubled = doubled_stream(spark, f"{root}/landing", schema, most)
        write = dedupe.append_unseen(f"{root}/table", "event_id", "day")
        files.run_available(doubled, f"{root}/checkpoint-{attempt}", write)
    return spark.read.parquet(f"{root}/table").drop("batch", "day")


@query("select * from events")
def stream_dedupe_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files and copies with bounded state; the delay covers their disorder."""
    root = work_dir(spark, "stream-within")
    schema, most = land_out_of_order(spark, sf_dir, f"{root}/landing")
    doubled = doubled_stream(spark, f"{root}/landing", schema, most)
    unique = dedupe.dedupe_within(doubled, "event_id", "ts", "3650 days")
    stream = (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/table")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    rows = spark.read.parquet(f"{root}/table").drop("day")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("select * from events")
def stream_dedupe_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files and copies with keyed state that expires after two days, far less than their disorder."""
    root = work_dir(spark, "stream-state")
    schema, most = land_out_of_order(spark, sf_dir, f"{root}/landing")
    keyed.use_rocksdb(spark)
    doubled = doubled_stream(spark, f"{root}/landing", schema, most)
    shards = max(8, 2 * most)  # a hundred thousand rows of a part each, over its days
    first = keyed.first_of_key(doubled, "event_id", "ts", "2 days", 86_400, shards)
    files.run_available(first, f"{root}/checkpoint", keyed.append_first(f"{root}/table", "event_id", "day"))
    return spark.read.schema(schema).parquet(f"{root}/table").select(*[f.name for f in schema if f.name != "day"])


@query(
    """with first as (
      select *, 'first' as run from events where ts < timestamp '2024-01-15 00:00:00'),
    marks as (select event_type, date_trunc('second', max(ts)) as since from first group by 1)
    select * from first
    union all
    select e.*, 'second' from events e left join marks using (event_type)
    where since is null or date_trunc('second', ts) > since"""
)
def stream_watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events arrive, then a file with all: only newer ones are added."""
    root = work_dir(spark, "stream-watermark")
    events = table(spark, sf_dir, "events")
    arrivals = (
        ("first", events.where(F.col("ts") < F.expr("timestamp_ntz'2024-01-15 00:00:00'"))),
        ("second", events),
    )
    landed = events.withColumn("run", F.lit("")).schema
    write = watermarks.append_newer(
        f"{root}/table", f"{root}/state", F.date_trunc("second", "ts"), "event_type"
    )
    for run, rows in arrivals:
        rows.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{root}/landing")
        stream = files.stream_files(spark, f"{root}/landing", landed, "parquet")
        files.run_available(stream, f"{root}/checkpoint", write)
    return spark.read.parquet(f"{root}/table").drop("batch")


#: A record of each stream that comes last and lies far behind all others, so that what waits is released.
LAST, LAST_UTC = "last", 2_000_000_000.0


def land_by_time(raw: DataFrame, folder: str, parts: int) -> None:
    """Records in files by ranges of their time, each under a folder of its own, and a last one."""
    low, high = raw.agg(F.min("created_utc"), F.max("created_utc")).first()
    width = max(((high or 0) - (low or 0)) / parts, 1e-6)
    part = F.least(F.floor((F.col("created_utc") - (low or 0)) / width), F.lit(parts - 1)).cast("int")
    for k in range(parts):
        raw.where(F.coalesce(part, F.lit(0)) == k).write.mode("append").json(folder)
    text = next(c for c in ("selftext", "body") if c in raw.columns)
    told = {"id": LAST, "parent_post_id": "none", text: LAST, "depth": 0, "created_utc": LAST_UTC}
    names = [f"{v!r} as {c}" if c in told else f"null as {c}" for c in raw.columns for v in [told.get(c)]]
    last = raw.sparkSession.sql(f"select {', '.join(names)}")
    last.select(*[F.col(f.name).cast(f.dataType) for f in raw.schema]).write.mode("append").json(folder)


@query(
    f"""with {STAGED_CTES}
    select p.id as post_id, p.title as post_title, p.body as post_body,
      p.author as post_author, p.score as post_score, p.upvote_ratio, p.num_comments,
      p.created_at as post_created_at, p.url as post_url, p.permalink as post_permalink,
      p.subreddit, p.subreddit_subscribers, p.over_18, p.link_flair_text,
      c.id as comment_id, c.body as comment_body, c.author as comment_author,
      c.score as comment_score, c.created_at as comment_created_at,
      c.permalink as comment_permalink, c.parent_id as comment_parent_id
    from stg_posts p left join stg_comments c on p.id = c.parent_post_id
      and c.created_at >= p.created_at - interval 5 minutes and c.created_at <= p.created_at + interval 2 hours"""
)
def fct_posts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and comments arrive in files by time; comments count from five minutes before their post to two hours after."""
    root = work_dir(spark, "stream-mart")
    land_by_time(posts(spark, sf_dir), f"{root}/posts", 3)
    land_by_time(comments(spark, sf_dir), f"{root}/comments", 3)
    arriving = [
        files.stream_files(spark, f"{root}/{name}", schema, files_per_batch=50)
        for name, schema in (("posts", schemas.POST), ("comments", schemas.COMMENT))
    ]
    joined = mart.stream_mart(*arriving, delay="1 hour", before="5 minutes", after="2 hours")
    stream = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/table")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{root}/table").where(F.col("post_id") != LAST)
