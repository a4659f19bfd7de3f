"""Raw records -> processed records -> staging models -> mart."""

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.times import epoch_to_ntz
from threadloom.operators import filters
from threadloom.operators.cleaning import with_clean_text
from threadloom.operators.dedupe import dedupe_landed, dedupe_records
from threadloom.operators.joins import HOT_ROWS, left_join_one_to_many
from threadloom.plans import manifest
from threadloom.sinks import tables as sinks
from threadloom.sources import files


Dedupe = Callable[[DataFrame], DataFrame]


def transform_posts(raw: DataFrame, dedupe: Dedupe = dedupe_records) -> DataFrame:
    """One row per post, its text cleaned."""
    posts = dedupe(raw.select(*schemas.POST.names))
    cleaned = with_clean_text(posts, "selftext", "clean_selftext")
    return cleaned.select(*schemas.PROCESSED_POST.names)


def transform_comments(raw: DataFrame, dedupe: Dedupe = dedupe_records) -> DataFrame:
    """One row per top-level comment, its text cleaned.

    Copies are resolved before the depth filter, as the surviving copy decides.
    """
    comments = filters.top_level_only(dedupe(raw.select(*schemas.COMMENT.names)))
    cleaned = with_clean_text(comments, "body", "clean_body")
    return cleaned.select(*schemas.PROCESSED_COMMENT.names)


def _staged(processed: DataFrame, text: str, order: list[str]) -> DataFrame:
    kept = filters.non_empty(processed, text)
    present = kept.withColumn("created_at", epoch_to_ntz(F.col("created_utc")))
    return present.withColumnRenamed(text, "body").select(
        *order, *[c for c in ("ingested_at",) if c in processed.columns]
    )


def stage_posts(processed: DataFrame) -> DataFrame:
    """Staging model of posts: renamed, typed, without empty texts."""
    order = [
        {"clean_selftext": "body", "created_utc": "created_at"}.get(c, c)
        for c in schemas.PROCESSED_POST.names
    ]
    return _staged(processed, "clean_selftext", order)


def stage_comments(processed: DataFrame) -> DataFrame:
    """Staging model of comments: renamed, typed, without empty texts."""
    order = [
        {"clean_body": "body", "created_utc": "created_at"}.get(c, c)
        for c in schemas.PROCESSED_COMMENT.names
    ]
    return _staged(processed, "clean_body", order)


# The mart's columns as (staging column, mart column).
MART_POST_COLUMNS = (
    ("id", "post_id"),
    ("title", "post_title"),
    ("body", "post_body"),
    ("author", "post_author"),
    ("score", "post_score"),
    ("upvote_ratio", "upvote_ratio"),
    ("num_comments", "num_comments"),
    ("created_at", "post_created_at"),
    ("url", "post_url"),
    ("permalink", "post_permalink"),
    ("subreddit", "subreddit"),
    ("subreddit_subscribers", "subreddit_subscribers"),
    ("over_18", "over_18"),
    ("link_flair_text", "link_flair_text"),
)
MART_COMMENT_COLUMNS = (
    ("id", "comment_id"),
    ("body", "comment_body"),
    ("author", "comment_author"),
    ("score", "comment_score"),
    ("created_at", "comment_created_at"),
    ("permalink", "comment_permalink"),
    ("parent_id", "comment_parent_id"),
)


def build_mart(
    stg_posts: DataFrame,
    stg_comments: DataFrame,
    hot_rows: int | None = HOT_ROWS,
    raw_comments: DataFrame | None = None,
) -> DataFrame:
    """One row per comment with its post's columns; posts without comments stay.

    Where the staged comments are not stored but computed, the raw ones tell hot posts
    without cleaning any text.
    """
    posts = stg_posts.select(*[F.col(a).alias(b) for a, b in MART_POST_COLUMNS])
    comments = stg_comments.select(
        *[F.col(a).alias(b) for a, b in MART_COMMENT_COLUMNS],
        F.col("parent_post_id").alias("_parent"),
    )
    if raw_comments is not None:
        raw_comments = raw_comments.select(F.col("parent_post_id").alias("_parent"))
    joined = left_join_one_to_many(
        posts,
        comments,
        "post_id",
        "_parent",
        spread_on=["comment_id"],
        hot_rows=hot_rows,
        count_from=raw_comments,
    )
    return joined.drop("_parent")


def build_models(
    sources: Mapping[str, DataFrame], mart_table: str | None = None
) -> dict[str, DataFrame]:
    """The staging models as views and the mart, saved as a table if a name is given.

    ``sources`` maps ``stg_posts`` and ``stg_comments`` to the loaded tables.
    """
    models = {
        "stg_posts": stage_posts(sources["stg_posts"]),
        "stg_comments": stage_comments(sources["stg_comments"]),
    }
    for name, frame in models.items():
        sinks.save_view(frame, name)
    models["fct_posts"] = build_mart(models["stg_posts"], models["stg_comments"])
    if mart_table:
        sinks.save_table(models["fct_posts"], mart_table)
        models["fct_posts"] = models["fct_posts"].sparkSession.table(mart_table)
    return models


def _dated(processed: DataFrame) -> DataFrame:
    return sinks.with_forum_date(processed.withColumn("_at", epoch_to_ntz(F.col("created_utc"))), "_at").drop("_at")


def run_transform(
    spark: SparkSession, raw: str, processed: str, multiline: bool = False
) -> None:
    """Raw JSON below ``raw``/posts and ``raw``/comments, every forum and run, to Parquet
    partitioned by forum. A forum without input is left as it is. For tables that grow run by
    run, by forum and day, see :func:`transform_runs`."""
    posts = files.read_posts(spark, f"{raw}/posts/*", multiline)
    comments = files.read_comments(spark, f"{raw}/comments/*", multiline)
    sinks.write_partitioned(transform_posts(posts), f"{processed}/posts", ["subreddit"])
    sinks.write_partitioned(transform_comments(comments), f"{processed}/comments", ["subreddit"])


def transform_runs(
    spark: SparkSession, raw: str, processed: str, runs: list[str], multiline: bool = False
) -> None:
    """Fold the raw JSON of new runs into the processed tables, partitioned by forum and day.

    Reads only ``raw``/posts/run=R and ``raw``/comments/run=R of the runs named, and
    of the tables only the days of a forum that hold or get a record that is new or differs, as
    a manifest beside each table tells. The newest record of an id survives, so repeating a run
    writes nothing. Runs and forums without input are left as they are.
    """
    for kind, read, clean, text in (
        ("posts", files.read_posts, transform_posts, "clean_selftext"),
        ("comments", files.read_comments, transform_comments, "clean_body"),
    ):
        landed = [read(spark, f"{raw}/{kind}/run={run}", multiline) for run in runs]
        if landed:
            fresh = clean(reduce(DataFrame.unionByName, landed), dedupe_landed)
            manifest.fold(_dated(fresh), f"{processed}/{kind}", "id", [F.col("created_utc").desc()], unique=True)
