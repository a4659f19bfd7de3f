"""The document manifest of an index: what it tells, what it spares, and broken runs."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from threadloom.plans import index, manifest

CHUNKS = "doc_id string, chunk_no int, chunk_text string, metadata map<string, string>, created_at timestamp_ntz, subreddit string"
DAYS = [datetime.datetime(2024, 1, 1 + k, 12) for k in range(6)]


def chunks(spark, rows):
    """Rows (doc, chunk texts, day, forum)."""
    made = [(doc, n, text, {"type": "post"}, day, forum) for doc, texts, day, forum in rows for n, text in enumerate(texts)]
    frame = spark.createDataFrame(made, CHUNKS)
    return frame.withColumn("chunk_id", F.md5(F.concat_ws("|", "doc_id", "chunk_no", "chunk_text"))).select(
        "doc_id", "chunk_no", "chunk_text", "metadata", "created_at", "chunk_id", "subreddit"
    )


def start(spark, n=24):
    return [(f"d{k}", [f"text {k}", "more"], DAYS[k % 6], "ab"[k % 2]) for k in range(n)]


def held(spark, path):
    return sorted((r["doc_id"], r["chunk_text"], r["subreddit"], str(r["date"]), r["run"]) for r in index.read_index(spark, path).collect())


def told(spark, path):
    """The manifest as it is, and as the index says it should be."""
    columns = ["doc", "places", "version", "run", "oldest", "newest"]
    kept = manifest.Manifest(spark, path).current().select(*columns)
    made = manifest.states(index.read_index(spark, path), F.col("run")).select(*columns)
    return sorted(map(str, kept.collect())), sorted(map(str, made.collect()))


def test_manifest_follows_the_index(spark, tmp_path):
    path, rows = str(tmp_path / "index"), start(spark)
    index.update_index(spark, chunks(spark, rows), path, "a")
    assert (lambda x: x[0] == x[1] and len(x[0]) == 24)(told(spark, path))
    rows[3] = ("d3", ["changed"], DAYS[3], "b")
    rows[4] = ("d4", ["text 4", "more"], DAYS[5], "b")  # moved only
    index.update_index(spark, chunks(spark, rows[2:6] + [("new", ["x"], None, None)]), path, "b")
    kept, made = told(spark, path)
    assert kept == made and len(kept) == 25
    assert {r[0] for r in held(spark, path) if r[4] == "b"} == {"d3", "d4", "new"}
    # A repeated run embeds again what it holds and drops what it no longer has.
    index.update_index(spark, chunks(spark, rows[3:4]), path, "b")
    kept, made = told(spark, path)
    assert kept == made and len(kept) == 23
    index.update_index(spark, chunks(spark, rows[6:8]), path, "c", oldest=DAYS[2])
    kept, made = told(spark, path)
    assert kept == made and not any("2024-01-01" in str(r) or "2024-01-02" in str(r) for r in held(spark, path))


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "index")
    incoming = index._as_indexed(chunks(spark, start(spark)), None)
    index.update_index(spark, chunks(spark, start(spark)), path, "a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.changed_documents(incoming, manifest.Manifest(spark, path).current(), "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(doc") == 1 == plan.count("Exchange")
    assert "SelectedBucketsCount: 4 out of 4" in plan


def test_untouched_partitions_are_not_read_or_written(spark, tmp_path):
    path, rows = str(tmp_path / "index"), start(spark)
    index.update_index(spark, chunks(spark, rows), path, "a")
    files = set(glob.glob(f"{path}/subreddit=*/date=*/*.parquet"))
    for old in files:  # a file that is read would fail the update
        if "subreddit=a/date=2024-01-03" not in old:
            os.truncate(old, 0)
    rows[2] = ("d2", ["changed"], DAYS[2], "a")
    index.update_index(spark, chunks(spark, rows), path, "b")
    now = set(glob.glob(f"{path}/subreddit=*/date=*/*.parquet"))
    assert {f for f in files if "subreddit=a/date=2024-01-03" not in f} <= now
    assert all("subreddit=a/date=2024-01-03" in f for f in now - files)


@pytest.mark.parametrize("step", ["write_partitioned", "append"])
def test_a_broken_run_is_mended_by_any_later_one(spark, tmp_path, monkeypatch, step):
    path, rows = str(tmp_path / "index"), start(spark)
    index.update_index(spark, chunks(spark, rows), path, "a")
    rows[0] = ("d0", ["moved"], DAYS[4], "b")
    with monkeypatch.context() as broken:
        owner = manifest.sinks if step == "write_partitioned" else manifest.Manifest
        original = getattr(owner, step)

        def fail(*args, **options):
            if step == "write_partitioned":
                original(*args, **options)
            raise RuntimeError("lost")

        broken.setattr(owner, step, fail)
        with pytest.raises(RuntimeError):
            index.update_index(spark, chunks(spark, rows), path, "b")
    assert not manifest.Manifest(spark, path).usable()
    index.update_index(spark, chunks(spark, [("d1", ["changed"], DAYS[1], "b"), *rows[:1]]), path, "c")
    kept, made = told(spark, path)
    assert kept == made and len(kept) == 24
    assert [r[1] for r in held(spark, path) if r[0] in ("d0", "d1")] == ["moved", "changed"]


def test_generations_are_compacted(spark, tmp_path):
    path, rows = str(tmp_path / "index"), start(spark, 6)
    index.update_index(spark, chunks(spark, rows), path, "run")
    for n in range(4):
        index.update_index(spark, chunks(spark, [(d, [f"{n}"], day, f) for d, _, day, f in rows]), path, f"run{n}")
        kept, made = told(spark, path)
        assert kept == made and len(kept) == 6
        assert manifest.Manifest(spark, path).all_rows().count() <= manifest.STALE_SHARE * 6
    assert len(glob.glob(f"{path}/_manifest/gen=*")) == 1


def fold(spark, path, rows):
    frame = spark.createDataFrame(rows, "id string, v int, t double, subreddit string, date date")
    return sorted((str(r["subreddit"]), str(r["date"])) for r in manifest.fold(frame, path, "id", [F.col("t").desc()]).collect())


def test_fold_rewrites_only_where_keys_lie_or_come(spark, tmp_path):
    path = str(tmp_path / "table")
    days = [datetime.date(2024, 1, 1 + k) for k in range(5)]
    rows = [(f"k{k}", k, 1.0, "fg"[k % 2], days[k % 5]) for k in range(40)]
    fold(spark, path, rows)
    untouched = set(glob.glob(f"{path}/subreddit=*/date=*/*.parquet"))
    assert fold(spark, path, rows) == []  # a repeated run writes nothing
    assert set(glob.glob(f"{path}/subreddit=*/date=*/*.parquet")) == untouched
    # A later copy, one that moves, a new one, an older one that loses, one without a place.
    changes = [("k0", 90, 2.0, "f", days[0]), ("k1", 91, 2.0, "f", days[3]), ("new", 92, 1.0, "g", days[2]), ("k3", 93, 0.5, "g", days[3]), ("odd", 94, 1.0, None, None)]
    assert fold(spark, path, changes) == sorted([("f", "2024-01-01"), ("f", "2024-01-04"), ("g", "2024-01-02"), ("g", "2024-01-03"), ("g", "2024-01-04"), ("None", "None")])
    assert fold(spark, path, changes[:3] + changes[4:]) == []
    want = {k: (k, v, t, f, d) for k, v, t, f, d in rows} | {c[0]: c for c in changes if c[0] != "k3"}
    got = spark.read.schema("id string, v int, t double, subreddit string, date date").parquet(path).collect()
    assert len(got) == 42 and {r["id"]: tuple(r) for r in got} == want


def test_fold_after_a_broken_run(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "table"), datetime.date(2024, 1, 1)
    fold(spark, path, [("a", 1, 1.0, "f", day), ("b", 1, 1.0, "g", day)])
    with monkeypatch.context() as broken:
        broken.setattr(manifest.Manifest, "append", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fold(spark, path, [("a", 2, 2.0, "g", day)])
    fold(spark, path, [("a", 3, 3.0, "f", day), ("c", 1, 1.0, "f", day)])
    assert {(r["id"], r["v"], r["subreddit"]) for r in spark.read.parquet(path).collect()} == {("a", 3, "f"), ("b", 1, "g"), ("c", 1, "f")}


@pytest.mark.parametrize("listed", [1000, 0])
def test_fold_of_unique_rows_stores_no_texts(spark, tmp_path, monkeypatch, listed):
    path, kept = str(tmp_path / "table"), []
    monkeypatch.setattr(manifest, "MAX_LISTED", listed)
    monkeypatch.setattr(manifest, "stored", lambda df, name, store=manifest.stored: kept.append(df.columns) or store(df, name))
    days = [datetime.date(2024, 1, 1 + k) for k in range(3)]

    def run(rows):
        frame = spark.createDataFrame(rows, "id string, v int, t double, subreddit string, date date")
        return manifest.fold(frame, path, "id", [F.col("t").desc()], unique=True).count()

    rows = [("a", 1, 1.0, "f", days[0]), ("b", 1, 1.0, "f", days[0]), ("c", 1, 1.0, "", days[1]), ("d", 1, 1.0, None, days[1]), ("e", 1, 1.0, "g x", days[1])]
    run(rows)
    assert run(rows) == 0
    # One moves and empties its folder, one differs beside one that does not come, one loses.
    assert run([("e", 2, 2.0, "f", days[2]), ("c", 2, 2.0, "", days[1]), ("a", 2, 0.5, "f", days[0]), ("b", 1, 1.0, "f", days[0])]) == 4
    got = {r["id"]: (r["v"], r["subreddit"], r["date"]) for r in spark.read.parquet(path).collect()}
    assert got == {"a": (1, "f", days[0]), "b": (1, "f", days[0]), "c": (2, None, days[1]), "d": (1, None, days[1]), "e": (2, "f", days[2])}
    assert spark.read.parquet(path).count() == 5
    assert kept and not any("v" in columns for columns in kept)
