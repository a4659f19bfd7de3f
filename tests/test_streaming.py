from datetime import datetime
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.catalog import streams
from threadloom.sources import state
from threadloom.streaming import dedupe, files, keyed, mart, watermarks

SCHEMA = "id string, subreddit string, created_utc double"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def stream(spark, path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return files.stream_files(spark, path, schema, **options)


def test_files_are_read_once_and_replays_add_nothing(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", "subreddit")

    def run():
        files.run_available(
            stream(spark, landing, files_per_batch=1), str(tmp_path / "checkpoint"), write
        )

    land(spark, landing, [("a", "f", 1.0), ("a", "f", 1.0), ("b", "f", 2.0)])
    run()
    run()  # a restart without new files
    assert ids(spark, table) == ["a", "b"]
    land(spark, landing, [("b", "f", 2.0), ("c", "f", 3.0)])
    land(spark, landing, [("a", "f", 1.0), ("d", "f", 4.0)])
    run()
    assert ids(spark, table) == ["a", "b", "c", "d"]


def test_a_new_checkpoint_keeps_the_table(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", "subreddit")
    land(spark, landing, [("a", "f", 1.0), ("b", "f", 2.0)])
    for checkpoint in ("one", "two"):
        files.run_available(stream(spark, landing), str(tmp_path / checkpoint), write)
    assert ids(spark, table) == ["a", "b"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    table = str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", "subreddit")
    batches = [
        spark.createDataFrame([("a", "f", 1.0), ("b", "f", 2.0)], SCHEMA),
        spark.createDataFrame([("b", "f", 2.0), ("c", "f", 3.0)], SCHEMA),
    ]
    for n in (0, 1, 1):
        write(batches[n], f"q-{n}")
    assert ids(spark, table) == ["a", "b", "c"]


def test_dedupe_compares_only_the_days_of_a_batch(spark, tmp_path):
    table = str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", day="day")

    def batch(*rows):
        frame = spark.createDataFrame(rows, SCHEMA)
        return frame.withColumn("day", F.to_date(F.timestamp_seconds("created_utc")))

    write(batch(("a", "f", 1.0), ("b", "f", 90000.0)), "q-0")
    write(batch(("a", "f", 1.0), ("c", "f", 2.0), ("c", "f", 2.0)), "q-1")
    write(batch(("b", "f", 90000.0), ("d", "f", 90001.0)), "q-2")
    assert ids(spark, table) == ["a", "b", "c", "d"]


def test_replays_without_a_day_add_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", "subreddit")
    rows = spark.createDataFrame([("a", None, 1.0), ("b", "f", 2.0), ("c", "g", 2.0)], SCHEMA)
    write(rows, "q-0")
    write(rows, "r-0")
    monkeypatch.setattr(dedupe, "MAX_LISTED_DAYS", 1)
    write(rows, "s-0")
    assert ids(spark, table) == ["a", "b", "c"]


def test_late_first_records_are_kept_by_the_table(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    write = dedupe.append_unseen(table, "id", "subreddit")
    for rows in ([("a", "f", 0.0)], [("b", "f", 36000.0)], [("late", "f", 100.0), ("a", "f", 0.0)], [("c", "f", 36001.0)]):
        land(spark, landing, rows)
        files.run_available(stream(spark, landing), str(tmp_path / "checkpoint"), write)
    assert ids(spark, table) == ["a", "b", "c", "late"]


def test_watermarks_drop_late_rows_and_repeats(spark, tmp_path):
    table, marks = str(tmp_path / "table"), str(tmp_path / "marks")
    created = F.timestamp_seconds("created_utc")
    write = watermarks.append_newer(table, marks, created)
    first = spark.createDataFrame([("a", "f", 10.0), ("b", "f", 20.0)], SCHEMA)
    second = spark.createDataFrame(
        [("late", "f", 15.0), ("equal", "f", 20.0), ("c", "f", 21.0), ("d", "g", 1.0)], SCHEMA
    )
    for n, batch in ((0, first), (1, second), (1, second)):
        write(batch, f"q-{n}")
    # A new checkpoint numbers its batches from 0 again.
    write(spark.createDataFrame([("b", "f", 20.0), ("c", "f", 21.0)], SCHEMA), "r-0")
    assert ids(spark, table) == ["a", "b", "c", "d"]
    got = {r.subreddit: r.last_ingested_utc for r in state.read_watermarks(spark, marks).collect()}
    assert got == {
        "f": datetime(1970, 1, 1, 0, 0, 21),
        "g": datetime(1970, 1, 1, 0, 0, 1),
    }


def test_dedupe_within_the_delay(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def run():
        rows = stream(spark, landing).withColumn("at", F.timestamp_seconds("created_utc"))
        query = (
            dedupe.dedupe_within(rows, "id", "at", "1 hour")
            .writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    land(spark, landing, [("a", "f", 30.0), ("b", "f", 60.0), ("a", "f", 30.0)])
    run()
    land(spark, landing, [("b", "f", 120.0), ("c", "f", 180.0)])
    run()
    assert ids(spark, table) == ["a", "b", "c"]


def test_keyed_state_expires_and_late_records_go_aside(spark, tmp_path):
    """Days arrive in order but for one that comes last: nothing is lost, and state holds the last days only."""
    keyed.use_rocksdb(spark)
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    rows = [(f"e{d}-{k}", f"2024-01-{d:02d} 10:{k:02d}:00") for d in range(1, 11) for k in range(20)]
    frame = spark.createDataFrame([*rows, ("none", None)], "id string, t string")
    frame = frame.select("id", F.col("t").cast("timestamp_ntz").alias("t"), F.to_date("t").alias("day")).cache()
    for d in (1, 2, 3, 5, 6, 7, 8, 9, 10):
        frame.where(f"day(day) = {d}").coalesce(1).write.mode("append").parquet(landing)
    for late in ("day(day) = 4", "day(day) in (1, 10)", "t is null", "t is null"):
        frame.where(late).coalesce(1).write.mode("append").parquet(landing)
    stream = files.stream_files(spark, landing, frame.schema, "parquet", files_per_batch=1)
    first = keyed.first_of_key(stream, "id", "t", "36 hours")
    seen = []

    def write(batch, name):
        seen.append({r["kind"]: r["n"] for r in batch.groupBy("kind").agg(F.count("*").alias("n")).collect()})
        keyed.append_first(table, "id", "day")(batch, name)

    query = files.run_available(first, str(tmp_path / "checkpoint"), write)
    got = spark.read.schema(frame.schema).parquet(table).select(*frame.columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, (tuple(r) for r in frame.collect())))
    assert sum(s.get("first", 0) for s in seen) == 180 and sum(s.get("late", 0) for s in seen) == 20 + 20 + 2
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # A value and a timer for each shard of the last two or three days, of ten.
    assert 0 < held[-1] <= 2 * 8 * 2 and max(held) <= 3 * 8 * 2


def test_stretches_behind_the_watermark_ask_no_state():
    asked = []
    processor = keyed.FirstOfKey("id", "millis", "kind", 1000)
    processor.seen = SimpleNamespace(get=lambda: asked.append("get"), exists=lambda: bool(asked.append("exists")), update=lambda v: None)
    processor.handle = SimpleNamespace(registerTimer=lambda t: None)
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 2000)
    for stretch, kind, calls in ((1, "late", []), (2, "first", ["get"])):
        rows = pd.DataFrame({"id": [1, 2], "millis": [1000 * stretch, 1000 * stretch + 999]})
        got = pd.concat(processor.handleInputRows((0, stretch), iter([rows]), now))
        assert list(got["kind"]) == [kind] * 2 and asked == calls


@pytest.mark.parametrize("name", ["stream_dedupe_state", "stream_dedupe", "stream_dedupe_within"])
def test_batches_take_many_files(spark, tmp_path, monkeypatch, name):
    """Forty files in three parts, eight at most in a batch: the batches are far fewer than the files."""
    monkeypatch.setattr(streams, "FILE_ROWS", 5)
    monkeypatch.setattr(streams, "BATCH_FILES", 8, raising=False)
    monkeypatch.setattr(streams, "work_dir", lambda *_: str(tmp_path / "work"))
    sql = "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 30 as int), 0, 0, 0)"
    events = spark.range(200).select(F.col("id").alias("event_id"), F.expr(sql).alias("ts"), F.lit("a").alias("event_type"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = getattr(streams, name)(spark, str(tmp_path)).select(*events.columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, events.collect()))
    checkpoint = "checkpoint-first" if name == "stream_dedupe" else "checkpoint"
    taken = [f for f in (tmp_path / "work" / checkpoint / "commits").iterdir() if f.name.isdigit()]
    assert len(list((tmp_path / "work" / "landing").glob("*.parquet"))) > 35 and 3 <= len(taken) <= 8


def test_stream_mart_joins_within_bounds_and_releases_orphans(spark, tmp_path):
    hour = 3600.0

    def post(n, at):
        return {"id": f"p{n}", "title": "t", "selftext": f"text {n}", "created_utc": at, "subreddit": "f"}

    def comment(n, of, at, depth=0):
        return {"id": f"c{n}", "body": f"answer {n}", "created_utc": at, "depth": depth, "parent_post_id": f"p{of}"}

    base = 1_700_000_000.0
    arrivals = [
        ([post(1, base), post(2, base)], [comment(1, 1, base + 60), comment(2, 1, base + 60, depth=1)]),
        ([post(1, base), post(3, base + 4 * hour)], [comment(1, 1, base + 60), comment(3, 2, base + 3 * hour)]),
        ([post(4, base + 50 * hour)], [comment(4, 3, base + 4 * hour - 30), comment(5, 4, base + 50 * hour)]),
        ([post(9, base + 500 * hour)], [comment(9, 9, base + 500 * hour)]),
    ]
    seen = []
    for posts, comments in arrivals:
        for kind, rows, schema in (("posts", posts, schemas.POST), ("comments", comments, schemas.COMMENT)):
            spark.createDataFrame([{f.name: r.get(f.name) for f in schema} for r in rows], schema).coalesce(1).write.mode("append").json(str(tmp_path / kind))
        streams = [files.stream_files(spark, str(tmp_path / k), s) for k, s in (("posts", schemas.POST), ("comments", schemas.COMMENT))]
        joined = mart.stream_mart(*streams, delay="5 hours", before="1 minute", after="2 hours")
        query = joined.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).option("path", str(tmp_path / "table")).trigger(availableNow=True).start()
        query.awaitTermination()
        seen.append({(r.post_id, r.comment_id) for r in spark.read.schema(joined.schema).parquet(str(tmp_path / "table")).collect()})
    assert seen[0] == {("p1", "c1")} and ("p2", None) not in seen[1]
    # The third comes too late for its post, the fourth within the minute before its own.
    assert seen[2] >= {("p1", "c1"), ("p3", "c4"), ("p4", "c5")}
    assert seen[3] - {("p9", "c9")} == {("p1", "c1"), ("p2", None), ("p3", "c4"), ("p4", "c5")}
    joins = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"] if "Join" in o["operatorName"]]
    assert joins[-1] <= 4
