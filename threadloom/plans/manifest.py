"""What a table partitioned by forum and day holds, one row per document, so that an update need not read it.

The manifest is a bucketed table beside the other: the document, where its rows lie, a hash of its
rows, the run that made them and their times. A run appends the rows of the
documents it changed; the row of the greatest ``seq`` counts. Window and joins on the document
keep the buckets, so the stored side is never shuffled. When appended rows outnumber the documents,
the rows that count are written as a new generation.

A marker tells that a run has begun to write the index; a run that finds one, or no manifest, makes
the manifest anew from the index.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.operators.dedupe import latest_by_key
from threadloom.session import stored
from threadloom.sinks import tables as sinks
from threadloom.sources import paths

PLACE = ["subreddit", "date"]
#: Most places that a filter lists.
MAX_LISTED = 1000

#: A generation is rewritten when it has this many times the rows that count.
STALE_SHARE = 2
COLUMNS = (
    "doc string, places array<struct<subreddit: string, date: date>>, version bigint, run string, "
    "oldest timestamp_ntz, newest timestamp_ntz, seq bigint, gone boolean"
)
NAMES = [c.strip().split()[0] for c in ("doc, places, version, run, oldest, newest, seq, gone").split(",")]


def states(rows: DataFrame, run: Column) -> DataFrame:
    """One row per document of index rows or chunks with (doc, chunk_id, subreddit, date, created_at)."""
    told = F.struct("chunk_id", F.coalesce("subreddit", F.lit("\x00")), F.coalesce(F.col("date").cast("string"), F.lit("\x00")))
    return rows.groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct("subreddit", "date"))).alias("places"),
        F.xxhash64(F.array_sort(F.collect_set(told))).alias("version"),
        F.max(run).alias("run"),
        F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest"),
    )


def _same_place(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in PLACE]


def in_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows that lie in some places, as partition filters unless there are more than a filter should list."""
    listed = places.select(*PLACE).limit(MAX_LISTED + 1).collect()
    if len(listed) > MAX_LISTED:
        return rows.alias("h").join(places.alias("t"), _same_place("h", "t"), "left_semi")
    days: dict[str | None, list] = {}
    for subreddit, date in listed:
        days.setdefault(subreddit, []).append(date)
    any_of = F.lit(False)
    for subreddit, dates in days.items():
        day = F.col("date").isin([d for d in dates if d is not None])
        day = day | F.col("date").isNull() if None in dates else day
        any_of = any_of | (F.col("subreddit").eqNullSafe(F.lit(subreddit)) & day)
    return rows.where(any_of)


def _folder_of(file: Column) -> Column:
    """The folder of a file whose path is told in the form of a URL."""
    return F.url_decode(F.replace(F.regexp_replace(file, "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))


def replace_places(table: DataFrame, rows: DataFrame, touched: DataFrame, path: str) -> None:
    """Write rows, which are stored elsewhere, in the place of all that the touched partitions of a table hold."""
    left = touched.alias("h").join(rows.select(*PLACE).distinct().alias("t"), _same_place("h", "t"), "left_anti")
    files = in_places(table, stored(left, "left")).select(_folder_of(F.col("_metadata.file_path")).alias("d"))
    folders = stored(files.distinct(), "folders")  # listed before any is rewritten
    sinks.write_partitioned(rows, path, PLACE)
    for row in folders.toLocalIterator():  # partitions that are left without a row
        paths.delete(table.sparkSession, row["d"])


def fold(
    incoming: DataFrame, path: str, key: str, order_by: list[Column], buckets: int | None = None, unique: bool = False
) -> DataFrame:
    """Fold rows into a table partitioned by forum and day, one row per key; returns the places rewritten.

    The manifest tells which keys are new or differ and where they lie now, so only those partitions are
    read and written, also if a key moves to another one, and a repeated run writes nothing. Of an
    incoming and a stored row of a key the first in order_by stays, the remaining columns break ties.

    ``unique`` tells that the incoming rows have one row per key already and can be computed again, so they
    are neither shuffled by key nor stored: what is joined with the manifest has no texts.
    """
    spark = incoming.sparkSession
    # A folder's name cannot be empty; such rows lie in the one of null.
    incoming = incoming.withColumn("subreddit", F.when(F.col("subreddit") != "", F.col("subreddit")))
    held = Manifest(spark, path, buckets)
    columns = sorted(c for c in incoming.columns if c not in PLACE)
    names = [F.col(key).cast("string").alias("doc")]
    none = F.lit(None).cast("timestamp_ntz")

    def told(rows: DataFrame) -> DataFrame:
        place = F.array(F.struct(F.col("subreddit"), F.col("date")))
        return rows.select(
            *names, place.alias("places"), F.xxhash64(F.to_json(F.struct(*columns, *PLACE))).alias("version"),
            F.lit("").alias("run"), none.alias("oldest"), none.alias("newest"),
        )

    def held_rows() -> DataFrame:
        return spark.read.schema(fresh.schema).parquet(path)

    fresh = incoming if unique else stored(latest_by_key(incoming, [key], order_by), "incoming")
    if not paths.exists(spark, f"{path}/{PLACE[0]}=*"):
        held.begin()
        sinks.write_partitioned(fresh, path, PLACE)
        held.create(told(held_rows()))
        held.end()
        return fresh.select(*PLACE).distinct()
    table = held_rows()
    if not held.usable():
        held.create(told(latest_by_key(table, [key], order_by)))
    known = held.current().select(F.col("doc").alias("_doc"), F.col("places").alias("moved_from"), F.col("version").alias("_version"))
    # A null key is no document's name; such rows never meet and are always folded in anew.
    joined = told(fresh).join(known, F.col("doc") == F.col("_doc"), "left")
    changed = stored(joined.where(~F.col("version").eqNullSafe(F.col("_version"))).select("doc", "places", "moved_from"), "changed")
    places = changed.select(F.explode("places").alias("at")).unionByName(changed.select(F.explode("moved_from").alias("at")))
    touched = stored(places.select("at.*").distinct(), "touched")
    if touched.isEmpty():
        return touched
    # An incoming row that does not differ lies where the stored one does, so the place tells all that are needed.
    merged = latest_by_key(in_places(table, touched).unionByName(in_places(fresh, touched)), [key], order_by)

    def files(rows: DataFrame) -> DataFrame:
        named = rows.select(*PLACE, F.col("_metadata.file_path").alias("f"))
        return in_places(named, touched).select("f").distinct()

    old = stored(files(table), "files")
    held.begin()
    # Spark writes a dynamic overwrite aside and moves it when all tasks are done, so it may read what it replaces.
    sinks.write_partitioned(merged, path, PLACE)
    after = held_rows()
    emptied = stored(files(after).join(old, "f", "left_semi").select(_folder_of(F.col("f")).alias("d")).distinct(), "emptied")
    if not emptied.isEmpty():
        for row in emptied.toLocalIterator():  # partitions that are left without a row
            paths.delete(spark, row["d"])
        after = held_rows()
    now = told(in_places(after, touched)).join(changed.select("doc"), "doc", "left_semi")
    held.append(now, changed.select("doc").limit(0))
    held.end()
    return touched


class Manifest:
    """The manifest of the table in a folder."""

    def __init__(self, spark: SparkSession, index: str, buckets: int | None = None):
        """Without a number of buckets, a new generation gets as many as a shuffle has partitions."""
        self.spark, self.root = spark, f"{index}/_manifest"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _generations(self) -> list[tuple[int, int]]:
        """(generation, buckets) of the complete generations, oldest first."""
        names = paths.children(self.spark, f"{self.root}/gen=*/_SUCCESS", parent=True)
        told = (name.removeprefix("gen=").split("-") for name in names)
        return sorted((int(generation), int(buckets)) for generation, buckets in told)

    def _folder(self, generation: int, buckets: int) -> str:
        return f"{self.root}/gen={generation:06d}-{buckets}"

    def _declared(self, generation: int, buckets: int) -> str:
        """The name of a generation as a table of this session; its number of buckets is in its folder's name."""
        folder = self._folder(generation, buckets)
        name = f"threadloom_manifest_{hashlib.md5(folder.encode()).hexdigest()[:20]}"
        self.spark.sql(
            f"create table if not exists {name} ({COLUMNS}) using parquet "
            f"clustered by (doc) sorted by (doc) into {buckets} buckets location '{folder}'"
        )
        self.spark.catalog.refreshTable(name)
        return name

    def usable(self) -> bool:
        """Whether there is a manifest that all finished runs, and no broken one, are in."""
        return bool(self._generations()) and not paths.exists(self.spark, f"{self.root}/pending")

    def begin(self) -> None:
        paths.touch(self.spark, f"{self.root}/pending")

    def end(self) -> None:
        paths.delete(self.spark, f"{self.root}/pending")

    def all_rows(self) -> DataFrame:
        return self.spark.table(self._declared(*self._generations()[-1]))

    def current(self) -> DataFrame:
        """The row that counts of every document in the index."""
        newest = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("seq")))
        return self.all_rows().withColumn("_n", newest).where((F.col("_n") == 1) & ~F.col("gone")).drop("_n")

    def create(self, rows: DataFrame) -> None:
        """A new generation of rows (doc, places, version, run, oldest, newest)."""
        last = self._generations()
        generation = last[-1][0] + 1 if last else 1
        self._insert(rows.withColumn("seq", F.lit(0).cast("long")).withColumn("gone", F.lit(False)), generation, self.buckets)
        for old in last:
            self.spark.sql(f"drop table if exists {self._declared(*old)}")
            paths.delete(self.spark, self._folder(*old))

    def append(self, changed: DataFrame, gone: DataFrame) -> None:
        """New rows of changed documents, and (doc) of those that have left the index."""
        generation, buckets = self._generations()[-1]
        last = self.all_rows().agg(F.max("seq")).first()[0] or 0
        rows = changed.withColumn("gone", F.lit(False)).unionByName(gone.select("doc").withColumn("gone", F.lit(True)), True)
        self._insert(rows.withColumn("seq", F.lit(last + 1).cast("long")), generation, buckets)
        held, counts = self.all_rows().count(), self.current().count()
        if held > STALE_SHARE * max(counts, 1):
            self.create(self.current().drop("seq", "gone"))

    def _insert(self, rows: DataFrame, generation: int, buckets: int) -> None:
        """One file per bucket: rows are dealt as the table's buckets are."""
        rows.select(*NAMES).repartition(buckets, "doc").write.insertInto(self._declared(generation, buckets))
