"""Listing, envelope, watermark and progress queries."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.catalog.registry import query, table
from threadloom.catalog.roles import COMMENTS_SQL, POSTS_SQL, comments, planted, posts, sql_strip
from threadloom.operators import incremental
from threadloom.plans import ingest
from threadloom.session import work_dir
from threadloom.sinks import state as state_sinks
from threadloom.sources import files, listings, state

PAGE_SIZE = 100


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as landed pages: per forum, up to 100 records with neighbouring ids."""
    raw = posts(spark, sf_dir)
    number = F.floor(F.col("id").cast("bigint") / PAGE_SIZE)
    children = F.array_sort(
        F.collect_list(
            F.struct(F.col("id").cast("bigint").alias("n"), F.struct(*raw.columns).alias("data"))
        )
    )
    nodes = F.transform(children, lambda c: F.struct(c["data"].alias("data")))
    after = F.concat(F.lit("page_"), (F.col("page") + 1).cast("string"))
    data = F.to_json(F.struct(after.alias("after"), "children"))
    return (
        raw.withColumn("page", number)
        .withColumn("forum", F.col("subreddit"))
        .groupBy("forum", "page")
        .agg(nodes.alias("children"))
        .select(
            "forum",
            "page",
            F.concat(F.lit('{"kind": "Listing", "data": '), data, F.lit("}")).alias("body"),
        )
    )


def comment_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments as landed responses: per post, up to 100 turns each."""
    turn = F.substring_index("id", "_", -1).cast("bigint")
    raw = comments(spark, sf_dir).withColumn("body", planted(F.col("body"), turn))
    kind = F.when(F.col("author") == "system", "more").otherwise("t1")
    fields = [c for c in raw.columns if c != "parent_post_id"]
    node = F.struct(kind.alias("kind"), F.struct(*fields).alias("data"))
    children = F.array_sort(F.collect_list(F.struct(turn.alias("turn"), node.alias("node"))))
    listing = F.struct(F.struct(children["node"].alias("children")).alias("data"))
    return (
        raw.withColumn("block", F.floor(turn / PAGE_SIZE))
        .groupBy(F.col("parent_post_id").alias("post_id"), "block")
        .agg(
            F.concat(F.lit('[{"kind": "Listing"}, '), F.to_json(listing), F.lit("]")).alias("body")
        )
    )


LISTED_CTE = f"""raw_posts as ({POSTS_SQL}),
listed as (
  select subreddit as forum, cast(id as bigint) // 100 as page,
    'page_' || (cast(id as bigint) // 100 + 1) as after,
    row_number() over (partition by subreddit, cast(id as bigint) // 100
      order by cast(id as bigint)) - 1 as position, * from raw_posts)"""


@query(f"with {LISTED_CTE} select * from listed")
def listing_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.unnest_listing(listing_pages(spark, sf_dir))


def unnested_sql(limit: int) -> str:
    body = (
        "case turn when 1 then '[deleted]' when 2 then ' [removed]' || chr(9) "
        "when 3 then '  ' else body end"
    )
    return f"""raw_comments as ({COMMENTS_SQL}),
    turned as (
      select *, cast(split_part(id, '_', 2) as bigint) as turn from raw_comments),
    numbered as (
      select * replace ({body} as body), row_number() over (
        partition by parent_post_id, turn // 100 order by turn) as place from turned),
    unnested as (
      select * exclude (turn, place) from numbered
      where place <= {limit} and author <> 'system'
        and {sql_strip("body")} not in ('', '[deleted]', '[removed]'))"""


@query(f"with {unnested_sql(5)} select * from unnested")
def envelope_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five nodes per response; other kinds and removed comments drop out."""
    return listings.unnest_comments(comment_envelopes(spark, sf_dir), limit=5)


@query(f"with {unnested_sql(100)} select * from unnested")
def envelope_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes; beside every response stand copies that do not parse and give no rows."""
    landed = comment_envelopes(spark, sf_dir)
    broken = landed.withColumn(
        "body", F.explode(F.array(F.concat(F.lit("{"), "body"), F.lit(""), F.lit(None), F.lit("[1]")))
    )
    return listings.unnest_comments(landed.unionByName(broken))


@query(
    f"""with {unnested_sql(100)}, done as (select cast(doc_id as varchar) as id from labels)
    select id, body, parent_post_id from raw_comments
      where parent_post_id in (select id from done)
    union all
    select id, body, parent_post_id from unnested
      where parent_post_id in (select cast(doc_id as varchar) from documents)
        and parent_post_id not in (select id from done)"""
)
def comments_with_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of finished posts are taken over, those of the rest are unnested."""
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    raw = comments(spark, sf_dir)
    fetched = raw.join(done, F.col("parent_post_id") == done["id"], "left_semi")
    envelopes = comment_envelopes(spark, sf_dir)
    merged = ingest.comments_with_resume(posts(spark, sf_dir), envelopes, done, fetched)
    return merged.select("id", "body", "parent_post_id")


@query(
    """select source, count(*) filter (where l.doc_id is not null) as done,
      count(*) filter (where l.doc_id is null) as remaining
    from documents d left join (select distinct doc_id from labels) l using (doc_id)
    group by source"""
)
def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return incremental.progress_counts(docs, labels, "doc_id", ["source"])


@query("select event_type, max(ts) as last_ingested_utc from events group by event_type")
def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return incremental.next_watermarks(events, F.col("ts"), "event_type")


@query(
    """with wm as (
      select event_type, max(ts) as since from events
      where ts < timestamp '2024-01-15 00:00:00' and event_type <> 'signup'
      group by event_type)
    select e.event_id, e.event_type, e.ts from events e left join wm using (event_type)
    where since is null or ts > since"""
)
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictly newer than the watermark of the type; one type has none."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    seen = events.where(
        (F.col("ts") < F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
        & (F.col("event_type") != "signup")
    )
    marks = incremental.next_watermarks(seen, F.col("ts"), "event_type")
    return incremental.newer_than_watermark(events, marks, F.col("ts"), "event_type")


@query(
    """select event_type as subreddit, date_trunc('second', max(ts)) as last_ingested_utc,
      timestamp '2024-02-01 00:00:00' as updated_at
    from events group by event_type"""
)
def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written by two runs; the older data comes second and moves nothing back."""
    path = work_dir(spark, "watermarks")
    events = table(spark, sf_dir, "events").withColumn("subreddit", F.col("event_type"))
    first_half = events.where(F.col("ts") < F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
    runs = (("a", events, datetime(2024, 1, 31)), ("b", first_half, datetime(2024, 2, 1)))
    for run, rows, as_of in runs:
        marks = incremental.next_watermarks(rows, F.col("ts").cast("timestamp"))
        state_sinks.upsert_watermarks(spark, path, marks, run, as_of)
    return state.read_watermarks(spark, path).select(
        "subreddit",
        F.col("last_ingested_utc").cast("timestamp_ntz").alias("last_ingested_utc"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


MARKS_CTE = """marks as (
  select subreddit, floor((min(created_utc) + max(created_utc)) / 2) as since
  from raw_posts where subreddit <> 'src0' group by subreddit)"""


@query(
    f"""with {LISTED_CTE}, {MARKS_CTE}
    select l.* exclude (forum, page, after, position) from listed l
      left join marks m on l.subreddit = m.subreddit
    where length({sql_strip("coalesce(selftext, '')")}) >= 30
      and (since is null or created_utc > since)
    qualify row_number() over (partition by l.subreddit order by page, position) <= 10"""
)
def ingest_new_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages -> enough text -> newer than the watermark -> first ten per forum."""
    raw = posts(spark, sf_dir).where("subreddit <> 'src0'")
    middle = F.floor((F.min("created_utc") + F.max("created_utc")) / 2)
    marks = raw.groupBy("subreddit").agg(F.timestamp_seconds(middle).alias("last_ingested_utc"))
    return ingest.new_posts(listing_pages(spark, sf_dir), marks, max_posts=10)


@query(
    f"""with {LISTED_CTE}
    select * exclude (forum, page, after, position) from listed
    where length({sql_strip("coalesce(selftext, '')")}) >= 30"""
)
def ingest_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capped run, then one without a cap: together they hold every post with enough text."""
    root = work_dir(spark, "ingest")
    pages, envelopes = listing_pages(spark, sf_dir), comment_envelopes(spark, sf_dir)
    ingest.run_ingest(spark, pages, envelopes, root, "first", max_posts=10)
    ingest.run_ingest(spark, pages, envelopes, root, "second")
    return files.read_posts(spark, f"{root}/posts/run=*")


@query("select distinct cast(doc_id as varchar) as id from labels where doc_id is not null")
def progress_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished ids written by two batches, the second twice, and read back."""
    path = work_dir(spark, "completed")
    done = table(spark, sf_dir, "labels").where("doc_id is not null").select(F.col("doc_id").alias("id"))
    state_sinks.add_completed(path, done.where("id % 3 = 0"), "first")
    for _ in range(2):
        state_sinks.add_completed(path, done, "second")
    return state.read_completed_ids(spark, path)


#: Ids and comments of one landed progress file, about.
PROGRESS_ROWS = 2000


def land_progress(done: DataFrame, fetched: DataFrame, path: str) -> None:
    """Files that hold a JSON array of progress records each: a page's finished ids and comments.

    A page of very many comments comes in several records. Files are as many as the rows ask for, not the pages.
    """
    number = max(1, -(-(done.count() + fetched.count()) // PROGRESS_ROWS))
    sizes = fetched.groupBy(F.col("page").alias("_page")).agg(F.ceil(F.count("*") / PROGRESS_ROWS).alias("_shares"))
    dealt = fetched.join(sizes, F.col("page").eqNullSafe(F.col("_page"))).withColumn("share", F.pmod(F.xxhash64("id"), F.col("_shares")))
    fields = [c for c in fetched.columns if c != "page"]
    dealt = dealt.groupBy("page", "share").agg(F.collect_list(F.struct(*fields)).alias("comments"))
    ids = done.groupBy("page").agg(F.collect_set("id").alias("completed_post_ids")).withColumn("share", F.lit(0).cast("long"))
    both = ids.join(dealt, ["page", "share"], "full").withColumn("status", F.lit("in_progress"))
    file = F.pmod(F.xxhash64("page", "share"), F.lit(number)).alias("file")
    record = F.struct("completed_post_ids", "comments", "status").alias("record")
    arrays = both.select(file, record).groupBy("file").agg(F.to_json(F.collect_list("record")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query(
    """select cast(doc_id as varchar) as id, 'done' as kind from labels where doc_id is not null
      group by doc_id
    union all
    select concat(cast(conv_id as varchar), '_', cast(turn as varchar)), 'comment'
      from conversations"""
)
def progress_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress files of an interrupted download, each with the ids and comments of some forum pages."""
    path = work_dir(spark, "progress")
    done = table(spark, sf_dir, "labels").where("doc_id is not null")
    done = done.select(F.floor(F.col("doc_id") / PAGE_SIZE).alias("page"), F.col("doc_id").cast("string").alias("id"))
    fetched = comments(spark, sf_dir)
    land_progress(done, fetched.withColumn("page", F.col("parent_post_id").cast("bigint")), path)
    ids, rows = state.read_progress(spark, path)
    return ids.select("id", F.lit("done").alias("kind")).unionByName(
        rows.select("id", F.lit("comment").alias("kind"))
    )
