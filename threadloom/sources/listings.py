"""Landed API responses, one JSON document per row, unnested into records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.text import is_removed


def unnest_listing(pages: DataFrame, body: str = "body") -> DataFrame:
    """Listing pages -> one row per post.

    The other columns of ``pages`` are kept, beside ``after`` (the token of the
    next page) and ``position`` (the place on the page). Pages that do not parse
    or hold no children give no rows.
    """
    keep = [c for c in pages.columns if c != body]
    page = F.from_json(body, schemas.LISTING_PAGE)
    parsed = pages.select(*keep, page.alias("_page"))
    nodes = parsed.select(
        *keep,
        F.col("_page.data.after").alias("after"),
        F.posexplode("_page.data.children").alias("position", "_node"),
    )
    fields = [F.col(f"_node.data.{f.name}").alias(f.name) for f in schemas.POST]
    own = [c for c in keep if c not in schemas.POST.names]
    return nodes.select(*own, "after", "position", *fields)


def unnest_comments(
    envelopes: DataFrame,
    post_id: str = "post_id",
    body: str = "body",
    limit: int | None = None,
) -> DataFrame:
    """Comment responses -> one row per comment with text, its post's id attached.

    The second element of a response holds the comment nodes, all of which are read;
    a ``limit`` keeps the first nodes of it. Nodes that are not comments and comments
    that are empty, deleted or removed are dropped. A response that does not parse
    gives no rows.
    """
    nodes = F.get(F.from_json(body, schemas.COMMENT_ENVELOPE), F.lit(1))["data"]["children"]
    if limit is not None:
        nodes = F.slice(nodes, 1, limit)
    rows = envelopes.select(
        F.col(post_id).cast("string").alias("_post"), F.explode(nodes).alias("_node")
    )
    fields = [
        F.col("_post").alias(f.name)
        if f.name == "parent_post_id"
        else F.col(f"_node.data.{f.name}").alias(f.name)
        for f in schemas.COMMENT
    ]
    return rows.where(F.col("_node.kind") == "t1").select(*fields).where(~is_removed(F.col("body")))
