"""Data-quality tests: each gives a count of failing records and the verdicts on it."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values occurring more than once, with their number of records; nulls are left out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def null_rows(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNull())


def _verdicts(test: Column, failures: Column) -> list[Column]:
    return [
        test.alias("test"),
        failures.alias("failures"),
        (failures != 0).alias("should_warn"),
        (failures != 0).alias("should_error"),
    ]


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """One verdict row: how many values of the key repeat."""
    failing = duplicate_keys(df, key).agg(F.count("*").alias("_n"))
    return failing.select(*_verdicts(F.lit(f"unique_{name}_{key}"), F.col("_n")))


def not_null(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One verdict row per column, from a single scan of just those columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    tests = F.array(
        *[
            F.struct(F.lit(f"not_null_{name}_{c}").alias("test"), F.col(c).alias("n"))
            for c in columns
        ]
    )
    rows = counts.select(F.inline(tests))
    return rows.select(*_verdicts(F.col("test"), F.col("n")))


def unique_and_not_null(df: DataFrame, key: str, name: str) -> DataFrame:
    """Both tests of a key from one grouping of it."""
    groups = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    is_null = F.col("_key").isNull()
    counts = groups.agg(
        F.count_if(~is_null & (F.col("_n") > 1)).alias("_repeated"),
        F.coalesce(F.sum(F.when(is_null, F.col("_n"))), F.lit(0)).alias("_null"),
    )
    tests = F.array(
        F.struct(F.lit(f"unique_{name}_{key}").alias("test"), F.col("_repeated").alias("n")),
        F.struct(F.lit(f"not_null_{name}_{key}").alias("test"), F.col("_null").alias("n")),
    )
    return counts.select(F.inline(tests)).select(*_verdicts(F.col("test"), F.col("n")))


def model_tests(stg_posts: DataFrame, stg_comments: DataFrame, mart: DataFrame) -> DataFrame:
    """The tests declared on the staging models and the mart."""
    return (
        unique_and_not_null(stg_posts, "id", "stg_posts")
        .unionAll(unique_and_not_null(stg_comments, "id", "stg_comments"))
        .unionAll(not_null(mart, ["post_id", "post_title"], "fct_posts"))
    )


def write_tested(
    df: DataFrame, path: str, name: str, not_null_columns: list[str], unique_key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write a model and test it in doing so: the model as written, and its verdict rows.

    Nulls are counted by the write itself, so the model is computed and scanned once. Of a key that must be
    unique, an estimate of its distinct values is taken along: where it is far below the number of rows,
    the key repeats and its column alone, as written, is grouped; else the same is done for the rows
    whose hash slot is shared, so that nearly all of a sound key is cleared by counting slots.
    """
    told = Observation()
    metrics = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null_columns]
    metrics += [F.count("*").alias("rows")]
    if unique_key:
        metrics += [F.count(unique_key).alias("keys"), F.approx_count_distinct(unique_key, 0.02).alias("distinct")]
    df.observe(told, *metrics).write.mode("overwrite").parquet(path)
    got, spark = told.get, df.sparkSession
    written = spark.read.schema(df.schema).parquet(path)
    rows = [(f"not_null_{name}_{c}", int(got[f"null_{c}"])) for c in not_null_columns]
    if unique_key:
        keys = written.select(unique_key)
        if got["distinct"] > 0.9 * got["keys"]:
            keys = suspects(keys, unique_key, got["keys"])
        rows.append((f"unique_{name}_{unique_key}", duplicate_keys(keys, unique_key).count()))
    tests = spark.createDataFrame(rows, "test string, n bigint")
    return written, tests.select(*_verdicts(F.col("test"), F.col("n")))


def suspects(keys: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows whose key shares a hash slot with another row; no key of the others repeats.

    There are about 64 slots for a row, as 64-bit numbers without the keys themselves, so what is counted is
    small however long the keys are.
    """
    bits = min(63, max(1, rows).bit_length() + 6)
    slot = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    shared = keys.where(F.col(key).isNotNull()).groupBy(slot.alias("_slot")).agg(F.count("*").alias("_n"))
    shared = shared.where("_n > 1").select("_slot")
    return keys.withColumn("_slot", slot).join(shared, "_slot", "left_semi").drop("_slot")


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows."""
    counts = [
        f.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name, f in frames.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionAll(more)
    return result
