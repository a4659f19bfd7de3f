"""Explicit schemas. A key missing from the JSON becomes null instead of failing analysis."""

from pyspark.sql import types as T

POST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("upvote_ratio", T.DoubleType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("subreddit_subscribers", T.LongType()),
        T.StructField("over_18", T.BooleanType()),
        T.StructField("link_flair_text", T.StringType()),
    ]
)

COMMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("parent_post_id", T.StringType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("subreddit", T.StringType()),
    ]
)


def renamed(schema: T.StructType, old: str, new: str) -> T.StructType:
    return T.StructType(
        [T.StructField(new if f.name == old else f.name, f.dataType) for f in schema]
    )


PROCESSED_POST = renamed(POST, "selftext", "clean_selftext")
PROCESSED_COMMENT = renamed(COMMENT, "body", "clean_body")

LISTING_PAGE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("after", T.StringType()),
                    T.StructField(
                        "children",
                        T.ArrayType(T.StructType([T.StructField("data", POST)])),
                    ),
                ]
            ),
        )
    ]
)

COMMENT_NODE = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("data", COMMENT)]
)

COMMENT_ENVELOPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField(
                "data", T.StructType([T.StructField("children", T.ArrayType(COMMENT_NODE))])
            ),
        ]
    )
)

WATERMARK = T.StructType(
    [
        T.StructField("subreddit", T.StringType()),
        T.StructField("last_ingested_utc", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

PROGRESS = T.StructType(
    [
        T.StructField("completed_post_ids", T.ArrayType(T.StringType())),
        T.StructField("comments", T.ArrayType(COMMENT)),
        T.StructField("saved_at", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
