"""Text, time and filter queries."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.catalog.registry import query, table
from threadloom.catalog.roles import (
    COMMENTS_SQL,
    PLANTED_SQL,
    POSTS_SQL,
    comments,
    planted,
    posts,
    sql_clean,
    sql_epoch,
    sql_strip,
)
from threadloom.functions import text as X
from threadloom.functions import times
from threadloom.operators import filters
from threadloom.operators.cleaning import with_clean_text
from threadloom.operators.dedupe import dedupe_records

AS_OF = datetime(2024, 1, 31)
MIDDLE = datetime(2024, 1, 16, 12)


@query(f"select doc_id, {sql_clean('text')} as clean_text from documents")
def clean_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return with_clean_text(docs, "text", "clean_text").select("doc_id", "clean_text")


@query(f"select conv_id, turn, {sql_clean('text')} as clean_text from conversations")
def clean_text_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return with_clean_text(turns, "text", "clean_text").select("conv_id", "turn", "clean_text")


@query(f"select page_id, {sql_clean('html')} as clean_text from pages")
def clean_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return with_clean_text(pages, "html", "clean_text").select("page_id", "clean_text")


@query(
    f"""select doc_id, length({sql_strip("coalesce(text, '')")}) as n_stripped,
    substring(source || ' ' || lang, 1, 4) as preview, list_extract(
      list_filter(list_transform(string_split(source || ', ' || lang || ',,', ','),
        lambda x: trim(x)), lambda x: x <> ''), 2) as second_item
    from documents"""
)
def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    items = X.split_list(F.concat("source", F.lit(", "), "lang", F.lit(",,")))
    return docs.select(
        "doc_id",
        X.stripped_length(F.col("text")).alias("n_stripped"),
        X.preview(F.concat_ws(" ", "source", "lang"), 4).alias("preview"),
        F.element_at(items, 2).alias("second_item"),
    )


@query(
    f"""with raw_posts as ({POSTS_SQL}) select * from raw_posts
    where length({sql_strip("coalesce(selftext, '')")}) >= 30"""
)
def low_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_low_quality(posts(spark, sf_dir))


@query(
    f"""with planted as (select conv_id, turn, {PLANTED_SQL} as body from conversations)
    select * from planted
    where {sql_strip("body")} not in ('', '[deleted]', '[removed]')"""
)
def removed_comment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    bodies = turns.select("conv_id", "turn", planted(F.col("text"), F.col("turn")).alias("body"))
    return filters.drop_removed(bodies)


@query(
    f"""with raw_comments as ({COMMENTS_SQL}),
    doubled as (
      select * from raw_comments
      union all select * replace (created_utc + 1 as created_utc, 1 - depth as depth)
        from raw_comments where author = 'assistant'),
    kept as (
      select * from doubled
      qualify row_number() over (partition by id order by created_utc desc) = 1)
    select * from kept where depth = 0"""
)
def top_level_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that differ in depth: the newest decides before the depth filter."""
    first = comments(spark, sf_dir)
    copies = first.where(F.col("author") == "assistant").withColumns(
        {"created_utc": F.col("created_utc") + 1, "depth": 1 - F.col("depth")}
    )
    return filters.top_level_only(dedupe_records(first.unionByName(copies)))


@query(
    f"""with e as (select event_id, epoch_us(ts) / 1000000 as epoch from events)
    select event_id, {sql_epoch("epoch")} as created_at,
      strftime({sql_epoch("epoch")}, '%Y-%m-%dT%H:%M:%SZ') as iso,
      {sql_epoch("epoch")} as parsed
    from e"""
)
def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000
    rows = events.select("event_id", times.epoch_to_ntz(epoch).alias("created_at"))
    rows = rows.withColumn("iso", times.format_utc(F.col("created_at")))
    return rows.withColumn("parsed", times.parse_utc(F.col("iso")).cast("timestamp_ntz"))


@query(
    """with last_runs as (
      select user_id, max(case when event_type = 'purchase' then ts end) as last_run
      from events group by user_id)
    select user_id, last_run is null
      or (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_run)) / 3600000000 > 6
      as stale
    from last_runs"""
)
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    last = F.max(F.when(F.col("event_type") == "purchase", F.col("ts")))
    runs = events.groupBy("user_id").agg(last.alias("last_run"))
    return runs.select("user_id", times.is_stale(F.col("last_run"), AS_OF).alias("stale"))


def _ago(divisor: int, unit: str) -> str:
    n = f"(s // {divisor})"
    return (
        f"'Last updated: ' || {n} || ' {unit}' || case when {n} > 1 then 's' else '' end || ' ago'"
    )


@query(
    f"""with e as (
      select event_id, case when event_type = 'error' then null else ts end as ts from events),
    d as (select event_id, ts,
      cast(floor((epoch_us(timestamp '2024-01-16 12:00:00') - epoch_us(ts)) / 1000000)
        as bigint) as s from e)
    select event_id, case when ts is null then 'Never ingested'
      when s < 60 then 'Last updated: just now'
      when s < 3600 then {_ago(60, "minute")}
      when s < 86400 then {_ago(3600, "hour")}
      else {_ago(86400, "day")} end as label
    from d"""
)
def freshness_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    last_run = F.when(F.col("event_type") != "error", F.col("ts"))
    return events.select("event_id", times.freshness_label(last_run, MIDDLE).alias("label"))


@query("select * from events where ts >= timestamp '2024-01-24 00:00:00'")
def rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rolling_window(table(spark, sf_dir, "events"), "ts", AS_OF, days=7)


@query("select doc_id, source from documents where contains(lower(text), 'the ')")
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return filters.keyword_search(docs, "text", "The ").select("doc_id", "source")


@query(
    """select conv_id, turn from conversations
    where list_has_any(string_split_regex(lower(text), '[ \\n\\t\\r]+'), ['with', 'pour'])"""
)
def word_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return filters.word_search(turns, "text", ["with", "Pour"]).select("conv_id", "turn")


@query(
    """select event_id, event_type, ts from events where event_type in ('click', 'view')
    and ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-20 00:00:00'"""
)
def metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return filters.by_metadata(
        events,
        ["click", "view"],
        F.expr("timestamp_ntz'2024-01-10 00:00:00'"),
        F.expr("timestamp_ntz'2024-01-20 00:00:00'"),
        forum="event_type",
        created_at="ts",
    ).select("event_id", "event_type", "ts")


@query("select event_id, coalesce(cast(props->>'$.k' as bigint), 0) as k from events")
def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    props = F.from_json("props", "k bigint")
    return events.select("event_id", F.coalesce(props["k"], F.lit(0)).alias("k"))
