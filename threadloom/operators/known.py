"""Which ids are known, told by bitmaps of hashed ids instead of the ids themselves.

A run adds the bitmaps of its ids, a bit per hash slot in blocks of 32,768; merging runs is a bitwise or.
An incoming id whose bit is not set is new without any look at the history. Only ids whose bit is set
are compared with the history exactly, so nothing is lost to a hash that two ids share; where there is
none, the history is not read at all.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import stored
from threadloom.sources import paths

#: Slots of the hash space. Take about sixteen for every id that will ever be known.
SLOT_BITS = 40
#: Most ids that are sent to every task of the exact comparison.
MAX_BROADCAST_IDS = 500_000
SCHEMA = "block bigint, bits binary, run string"


def _slot(key: str, slot_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - slot_bits)


def add_known(ids: DataFrame, path: str, key: str, run: str, slot_bits: int = SLOT_BITS) -> None:
    """Add the ids of a run; repeating a run replaces what it wrote. Null ids are never known.

    Bits are set per task before the shuffle, so a block moves once per task, not once per id.
    """
    slots = ids.where(F.col(key).isNotNull()).select(_slot(key, slot_bits).alias("slot"))
    blocks = slots.groupBy(F.bitmap_bucket_number("slot").alias("block"))
    bitmaps = blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bitmaps.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    """(block, bits) of all runs together."""
    if not paths.exists(spark, f"{path}/run=*/_SUCCESS"):
        return spark.createDataFrame([], "block bigint, bits binary")
    runs = spark.read.schema(SCHEMA).option("basePath", path).parquet(f"{path}/run=*")
    return runs.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def compact(spark: SparkSession, path: str, run: str) -> None:
    """All runs as one. What it replaces goes only when it is written, so a broken call changes nothing."""
    before = [name for name in paths.children(spark, f"{path}/run=*/_SUCCESS", parent=True) if name != f"run={run}"]
    stored(read_bitmaps(spark, path), "bitmaps").write.mode("overwrite").parquet(f"{path}/run={run}")
    for name in before:
        paths.delete(spark, f"{path}/{name}")


def split_by_bitmap(df: DataFrame, bitmaps: DataFrame, key: str, slot_bits: int = SLOT_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows of df that are surely new, and those whose bit is set. Rows with a null id are new."""
    slot = _slot(key, slot_bits)
    rows = df.withColumn("_block", F.when(F.col(key).isNotNull(), F.bitmap_bucket_number(slot)))
    rows = rows.withColumn("_bit", F.bitmap_bit_position(slot))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    set_ = F.coalesce(F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1, F.lit(False))
    told = rows.join(bitmaps, F.col("_block") == F.col("block"), "left").withColumn("_byte", byte).withColumn("_set", set_)
    told = stored(told.select(*df.columns, "_set"), "told")
    return told.where(~F.col("_set")).drop("_set"), told.where("_set").drop("_set")


def not_known(df: DataFrame, bitmaps: DataFrame, history: DataFrame, key: str, slot_bits: int = SLOT_BITS) -> DataFrame:
    """Rows whose id is not in the history, of which bitmaps has every id (and may have more)."""
    new, hits = split_by_bitmap(df, bitmaps, key, slot_bits)
    ids = hits.select(key).distinct()
    n = ids.limit(MAX_BROADCAST_IDS + 1).count()
    if not n:
        return new
    few = F.broadcast(ids) if n <= MAX_BROADCAST_IDS else ids
    confirmed = history.select(key).join(few, key, "left_semi").distinct()
    return new.unionByName(hits.join(confirmed, key, "left_anti"))
