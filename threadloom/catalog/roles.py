"""The test tables in the role of raw posts and comments, in Spark and in SQL.

documents are the posts and conversations the comments; columns the tables do not
have are derived from those they do.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.catalog.registry import table
from threadloom.functions.text import INLINE_MARKUP, WHITESPACE_CLASS


def _selected(df: DataFrame, exprs: dict[str, str], schema) -> DataFrame:
    return df.select(
        *[F.expr(exprs[f.name]).cast(f.dataType).alias(f.name) for f in schema]
    )


# Both dialects read these expressions alike.
POST_EXPRS = {
    "id": "cast(doc_id as string)",
    "title": "concat(source, ' ', lang)",
    "selftext": "text",
    "author": "concat('author_', lang)",
    "score": "n_chars",
    "upvote_ratio": "n_chars / (n_chars + cast(100 as double))",
    "num_comments": "doc_id",
    "created_utc": "cast(1700000000 as double) + doc_id * cast(60.5 as double)",
    "url": "concat('https://forum.example/', cast(doc_id as string))",
    "permalink": "concat('/p/', cast(doc_id as string))",
    "subreddit": "source",
    "subreddit_subscribers": "n_chars * 10",
    "over_18": "lang = 'de'",
    "link_flair_text": "lang",
}
COMMENT_EXPRS = {
    "id": "concat(cast(conv_id as string), '_', cast(turn as string))",
    "body": "text",
    "author": "role",
    "score": "length(text)",
    "created_utc": "cast(1700000000 as double) + conv_id * 60 + turn + cast(0.25 as double)",
    "depth": "case when role = 'user' then 0 else 1 end",
    "parent_id": "concat('t3_', cast(conv_id as string))",
    "parent_post_id": "cast(conv_id as string)",
    "permalink": "concat('/c/', cast(conv_id as string), '/', cast(turn as string))",
    "subreddit": "'forum'",
}


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(table(spark, sf_dir, "documents"), POST_EXPRS, schemas.POST)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(table(spark, sf_dir, "conversations"), COMMENT_EXPRS, schemas.COMMENT)


def _sql_select(exprs: dict[str, str], source: str) -> str:
    return f"select {', '.join(f'{e} as {c}' for c, e in exprs.items())} from {source}"


POSTS_SQL = _sql_select(POST_EXPRS, "documents")
COMMENTS_SQL = _sql_select(COMMENT_EXPRS, "conversations")


def planted(body: Column, turn: Column) -> Column:
    """Puts removal markers and blanks in the place of some texts."""
    return (
        F.when(turn == 1, "[deleted]")
        .when(turn == 2, " [removed]\t")
        .when(turn == 3, "  ")
        .otherwise(body)
    )


PLANTED_SQL = (
    "case when turn = 1 then '[deleted]' when turn = 2 then ' [removed]' || chr(9) "
    "when turn = 3 then '  ' else text end"
)


def sql_strip(expr: str) -> str:
    ws = WHITESPACE_CLASS
    return f"regexp_replace({expr}, '^[{ws}]+|[{ws}]+$', '', 'g')"


def sql_unescape(expr: str) -> str:
    """Decodes the entities that occur in the tables, ``&amp;`` last.

    These old names count without their semicolon as well.
    """
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{entity};?', '{char}', 'g')"
    return expr


def sql_clean(expr: str) -> str:
    expr = sql_unescape(f"coalesce({expr}, '')")
    for _, pattern in INLINE_MARKUP:
        expr = f"regexp_replace({expr}, '{pattern}', '\\1', 'g')"
    expr = f"regexp_replace({expr}, 'http[^{WHITESPACE_CLASS}]+', '', 'g')"
    expr = f"replace({expr}, chr(10), ' ')"
    expr = f"regexp_replace({expr}, ' +', ' ', 'g')"
    return sql_strip(expr)


def sql_epoch(expr: str) -> str:
    return f"make_timestamp(cast(round({expr}) as bigint) * 1000000)"


STAGED_CTES = f"""
raw_posts as ({POSTS_SQL}),
raw_comments as ({COMMENTS_SQL}),
clean_posts as (
  select *, {sql_clean("selftext")} as clean_selftext from raw_posts
  qualify row_number() over (partition by id order by created_utc desc) = 1
),
unique_comments as (
  select * from raw_comments
  qualify row_number() over (partition by id order by created_utc desc) = 1
),
clean_comments as (
  select *, {sql_clean("body")} as clean_body from unique_comments where depth = 0
),
stg_posts as (
  select id, title, clean_selftext as body, author, score, upvote_ratio, num_comments,
    {sql_epoch("created_utc")} as created_at, url, permalink, subreddit,
    subreddit_subscribers, over_18, link_flair_text
  from clean_posts where clean_selftext is not null and clean_selftext <> ''
),
stg_comments as (
  select id, clean_body as body, author, score, {sql_epoch("created_utc")} as created_at,
    depth, parent_id, parent_post_id, permalink, subreddit
  from clean_comments where clean_body is not null and clean_body <> ''
),
fct_posts as (
  select p.id as post_id, p.title as post_title, p.body as post_body,
    p.author as post_author, p.score as post_score, p.upvote_ratio, p.num_comments,
    p.created_at as post_created_at, p.url as post_url, p.permalink as post_permalink,
    p.subreddit, p.subreddit_subscribers, p.over_18, p.link_flair_text,
    c.id as comment_id, c.body as comment_body, c.author as comment_author,
    c.score as comment_score, c.created_at as comment_created_at,
    c.permalink as comment_permalink, c.parent_id as comment_parent_id
  from stg_posts p left join stg_comments c on p.id = c.parent_post_id
)
"""
