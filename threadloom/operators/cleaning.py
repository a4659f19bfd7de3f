"""Cleaned text as a column of a frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as X


def with_clean_text(df: DataFrame, source: str, target: str) -> DataFrame:
    """Adds the plain text of ``source`` as ``target``.

    Each step is a projection of its own, because its guard and its pattern both read
    what the step before gave. The last one is an explode of one element: a filter on
    the result stays above it, where it would otherwise be pushed below and clean
    every text a second time. Filters on other columns still reach the scan.
    """
    text = F.col("_text")
    steps = df.withColumn("_text", X.html_unescape(F.coalesce(F.col(source), F.lit(""))))
    for step in X.markup_steps():
        steps = steps.withColumn("_text", step(text))
    return steps.select(*df.columns, F.explode(F.array(X.strip(text))).alias(target))
