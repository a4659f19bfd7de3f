"""Removal of lines that many sites share.

The spread of a line is the number of distinct sites (sources) whose documents hold it.
HyperLogLog sketches per line hash, merged by aggregation, estimate it; lines whose estimate
is near the threshold are counted exactly. A document of which nothing but blank lines would be
left is a copy rather than a page with boilerplate, and stays as it is, for a near-duplicate
stage to judge. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import fresh, stored

MIN_SITES = 10
#: Relative error of the sketches: 256 registers, almost exact for counts as small as the threshold.
ERROR = 0.07
#: Estimates from MIN_SITES / NEAR to MIN_SITES * NEAR are counted exactly.
NEAR = 2.0


def line_key(line: Column) -> Column:
    """What makes two lines the same: the line without surrounding spaces; blank lines have none."""
    trimmed = F.trim(line)
    return F.when(trimmed != "", F.xxhash64(trimmed))


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Rows (key, n_sites) of the line keys held by min_sites sites or more, from rows (key, site).

    Partial aggregation merges the sketches of a task before the shuffle, so a line with very
    many rows sends one sketch per task; its distinct sites are as many rows at most. n_sites is
    exact near the threshold and an estimate above it.
    """
    sketched = lines.groupBy("key").agg(F.approx_count_distinct("site", ERROR).alias("n"))
    sketched = stored(sketched.where(F.col("n") >= min_sites / NEAR), "lines")
    sure = sketched.where(F.col("n") > min_sites * NEAR)
    near = sketched.where(F.col("n") <= min_sites * NEAR)
    exact = lines.join(near.select("key"), "key", "left_semi").distinct().groupBy("key").agg(F.count("*").alias("n"))
    return sure.unionByName(exact.where(F.col("n") >= min_sites)).withColumnRenamed("n", "n_sites")


def strip_shared_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    into: tuple[str, str] | None = ("n_lines", "n_removed"),
) -> DataFrame:
    """docs with text replaced and, unless into is None, two counts added; every row stays.

    Lines are separated by newlines. Blank lines are never shared and stay where they are. A document
    whose other lines are all shared is a copy as a whole and keeps them. A null source is no site: its
    lines count for no one but are removed like others. Null text stays null with no lines; rows that
    share an id lose the same lines, and rows with a null id those of the same text. Columns of docs
    named as in into are replaced; all others stay.
    """
    # Without an id the text stands for it, so that rows with a null id are no group.
    text, key = F.col(text_col), [F.col(id_col), F.when(F.col(id_col).isNull(), F.xxhash64(text_col))]
    lines = docs.select(
        key[0].alias("id"), key[1].alias("alt"), F.col(site_col).alias("site"), F.explode(F.split(text_col, "\n")).alias("line")
    ).select("id", "alt", "site", "line", line_key(F.col("line")).alias("key"))
    shared = shared_lines(lines.where("key is not null and site is not null").select("key", "site"), min_sites)
    hits = lines.join(stored(shared.select("key"), "shared"), "key", "left_semi").groupBy("id", "alt").agg(F.collect_set("line").alias("gone"))
    rest = docs.drop(*into) if into else docs
    gone, own, other, kept = fresh(rest, "gone", "own", "other", "kept")
    hits = hits.select(F.col("id").alias(own), F.col("alt").alias(other), F.col("gone").alias(gone))
    joined = rest.join(hits, rest[id_col].eqNullSafe(F.col(own)) & key[1].eqNullSafe(F.col(other)), "left")
    lines_of = F.split(text, "\n")
    left = F.filter(lines_of, lambda x: ~F.array_contains(gone, x))
    cut = F.col(gone).isNotNull() & F.exists(left, lambda x: F.trim(x) != "")
    out = joined.withColumn(kept, F.when(cut, left).otherwise(lines_of))
    if into:
        count = F.when(text.isNull(), 0).otherwise(F.size(lines_of))
        out = out.withColumn(into[0], count).withColumn(into[1], F.when(text.isNull(), 0).otherwise(count - F.size(kept)))
    return out.withColumn(text_col, F.array_join(kept, "\n")).select(*rest.columns, *(into or ()))
