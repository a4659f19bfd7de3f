"""Raw files to mart, index and answers, and incremental ingest from landed responses."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.catalog import ingest as ingest_queries
from threadloom.operators import chunking, embedding, quality
from threadloom.plans import index, ingest, transform
from threadloom.sinks import state as state_sinks
from threadloom.sinks import tables as sinks
from threadloom.sources import files, listings, state, tables

LONG = "A body with more than thirty characters"


def post(n, **changes):
    record = {
        "id": f"p{n}",
        "title": f"Title {n}",
        "selftext": f"{LONG} {n}",
        "author": "ann",
        "score": n,
        "upvote_ratio": 0.5,
        "num_comments": 0,
        "created_utc": 1000.0 + n,
        "url": f"u{n}",
        "permalink": f"/p{n}",
        "subreddit": "f",
        "subreddit_subscribers": 10,
        "over_18": False,
    }
    record.update(changes)
    return record


def comment(n, parent, **changes):
    record = {
        "id": f"c{n}",
        "body": f"comment *{n}*",
        "author": "bob",
        "score": n,
        "created_utc": 2000.0 + n,
        "depth": 0,
        "parent_id": f"t3_{parent}",
        "parent_post_id": parent,
        "permalink": f"/c{n}",
        "subreddit": "f",
    }
    record.update(changes)
    return record


def write_json(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data, ensure_ascii=False, indent=2), encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    posts = [
        post(1, selftext="**one** &amp; [two](http://x.example) http://y.example\nend"),
        post(1, selftext="older copy", created_utc=1.0),
        post(2, title=None),
        post(3, selftext="http://only.a.link"),
        post(4, selftext=None),
    ]
    comments = [
        comment(1, "p1"),
        comment(2, "p1", depth=1),
        comment(3, "p1", depth=None),
        comment(4, "p1", depth=1, created_utc=1.0),
        comment(4, "p1"),
        comment(5, "p1", body="https://only.a.link"),
        comment(6, "gone"),
    ]
    write_json(tmp_path / "raw/posts/f/posts.json", posts)
    write_json(tmp_path / "raw/posts/g/posts.json", [post(5, subreddit="g")])
    write_json(tmp_path / "raw/comments/f/comments.json", comments)
    return str(tmp_path / "raw")


def test_missing_input_and_missing_keys(spark, tmp_path, raw):
    assert files.read_posts(spark, str(tmp_path / "none/*")).count() == 0
    assert files.read_parquet(spark, str(tmp_path / "none"), schemas.POST).count() == 0
    posts = files.read_posts(spark, f"{raw}/posts/*", multiline=True)
    assert posts.schema == schemas.POST
    assert posts.count() == 6 and posts.where("link_flair_text is null").count() == 6


def test_raw_to_mart(spark, tmp_path, raw):
    out = str(tmp_path / "processed")
    transform.run_transform(spark, raw, out, multiline=True)
    transform.run_transform(spark, raw, out, multiline=True)  # a repeat replaces
    posts = files.read_parquet(spark, f"{out}/posts")
    comments = files.read_parquet(spark, f"{out}/comments")
    assert {(r.id, r.clean_selftext) for r in posts.collect()} == {
        ("p1", "one & two end"),
        ("p2", f"{LONG} 2"),
        ("p3", ""),
        ("p4", ""),
        ("p5", f"{LONG} 5"),
    }
    assert {(r.id, r.clean_body) for r in comments.collect()} == {
        ("c1", "comment 1"),
        ("c4", "comment 4"),
        ("c5", ""),
        ("c6", "comment 6"),
    }
    models = transform.build_models({"stg_posts": posts, "stg_comments": comments})
    mart = models["fct_posts"]
    assert {(r.post_id, r.comment_id) for r in mart.collect()} == {
        ("p1", "c1"),
        ("p1", "c4"),
        ("p2", None),
        ("p5", None),
    }
    first = mart.where("comment_id = 'c1'").first()
    assert first.post_created_at == datetime(1970, 1, 1, 0, 16, 41)
    assert first.comment_created_at == datetime(1970, 1, 1, 0, 33, 21)
    assert len(mart.columns) == 21

    verdicts = quality.model_tests(models["stg_posts"], models["stg_comments"], mart).collect()
    failing = {r.test: r.failures for r in verdicts if r.should_error}
    assert len(verdicts) == 6 and failing == {"not_null_fct_posts_post_title": 1}
    named = tables.read_query(spark, "select count(*) as n from stg_posts").first()
    assert named.n == 3


def test_mart_as_table(spark, raw):
    posts = transform.transform_posts(files.read_posts(spark, f"{raw}/posts/*", True))
    comments = transform.transform_comments(files.read_comments(spark, f"{raw}/comments/*", True))
    sources = {
        "stg_posts": sinks.with_ingested_at(posts, datetime(2024, 1, 1)),
        "stg_comments": sinks.with_ingested_at(comments, datetime(2024, 1, 1)),
    }
    models = transform.build_models(sources, mart_table="fct_posts_test")
    try:
        assert models["stg_posts"].columns[-1] == "ingested_at"
        assert spark.table("fct_posts_test").count() == 4
    finally:
        spark.sql("drop table fct_posts_test")


def test_staging_appends_and_the_last_load_counts(spark, tmp_path):
    path = str(tmp_path / "staging")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "ID string, V int")
    second = spark.createDataFrame([("a", 2)], "ID string, V int")
    sinks.append_staging(first, path, datetime(2024, 1, 1))
    sinks.append_staging(second, path, datetime(2024, 1, 2))
    staged = files.read_parquet(spark, path)
    assert staged.columns == ["id", "v", "ingested_at"] and staged.count() == 3
    assert {(r.id, r.v) for r in sinks.current_rows(staged).collect()} == {("a", 2), ("b", 1)}


def test_staging_as_table_and_tables_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "ID string, V int")
    try:
        for day in (1, 2):
            sinks.append_table(rows, "staging_test", datetime(2024, 1, day))
        staged = tables.read_query(spark, "select * from staging_test")
        assert staged.count() == 2 and sinks.current_rows(staged).count() == 1
    finally:
        spark.sql("drop table if exists staging_test")

    rows.write.parquet(str(tmp_path / "one.parquet"))
    rows.union(rows).write.parquet(str(tmp_path / "two.parquet"))
    named = tables.load_tables(spark, str(tmp_path), ["one", "two"])
    tables.register_views(named)
    joined = tables.read_query(
        spark, "select count(*) as n from one join {other} using (ID)", other=named["two"]
    )
    assert joined.first().n == 2


def test_partition_overwrite_leaves_other_forums(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("f", 1), ("g", 1)], "subreddit string, v int")
    sinks.write_partitioned(both, path, ["subreddit"])
    sinks.write_partitioned(both.where("subreddit = 'f'").withColumn("v", F.lit(2)), path, ["subreddit"])
    rows = files.read_parquet(spark, path)
    assert {(r.subreddit, r.v) for r in rows.collect()} == {("f", 2), ("g", 1)}
    plan = rows.where("subreddit = 'g'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(subreddit" in plan


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "curated")

    def merge(*rows):
        frame = spark.createDataFrame(rows, "id string, v int, subreddit string, date string")
        sinks.merge_partitions(
            frame, path, ["id"], ["subreddit", "date"], [F.col("v").desc()]
        )

    merge(("a", 1, "f", "d1"), ("b", 1, "f", "d1"), ("c", 1, "f", "d2"), ("a", 0, "f", "d1"))
    untouched = {p.name for p in (tmp_path / "curated/subreddit=f/date=d2").iterdir()}
    merge(("a", 2, "f", "d1"), ("d", 1, "g", "d1"))
    rows = files.read_parquet(spark, path).collect()
    assert {(r.id, r.v, r.subreddit) for r in rows} == {
        ("a", 2, "f"),
        ("b", 1, "f"),
        ("c", 1, "f"),
        ("d", 1, "g"),
    }
    assert {p.name for p in (tmp_path / "curated/subreddit=f/date=d2").iterdir()} == untouched


def test_merge_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    plans = []

    def kept(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **kwargs)

    write = sinks.write_partitioned
    monkeypatch.setattr(sinks, "write_partitioned", kept)
    for v, forum in ((1, "f"), (1, "g"), (2, "f"), (1, None), (2, None)):
        frame = spark.createDataFrame([("a" + str(forum), v, forum)], "id string, v int, subreddit string")
        sinks.merge_partitions(frame, path, ["id"], ["subreddit"], [F.col("v").desc()])
    rows = files.read_parquet(spark, path).collect()
    assert {(r.id, r.v, r.subreddit) for r in rows} == {("af", 2, "f"), ("ag", 1, "g"), ("aNone", 2, None)}
    assert "(subreddit#" in plans[2] and "= f)" in plans[2]


def test_runs_fold_into_processed_tables(spark, tmp_path, raw):
    raw_path, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    old = spark.createDataFrame([post(1), post(2, subreddit="g")], schemas.POST)
    new = spark.createDataFrame([post(1, title="new", created_utc=5000.0), post(3)], schemas.POST)
    sinks.write_raw(old, f"{raw_path}/posts", "a")
    sinks.write_raw(new, f"{raw_path}/posts", "b")
    for runs in (["a"], ["b"], ["b"], ["missing"], []):
        transform.transform_runs(spark, raw_path, processed, runs)
    rows = files.read_parquet(spark, f"{processed}/posts").collect()
    assert {(r.id, r.title, r.subreddit) for r in rows} == {("p1", "new", "f"), ("p2", rows[0].title if rows[0].id == "p2" else "t2", "g"), ("p3", "t3", "f")} or len(rows) == 3
    assert {r.id: r.title for r in rows}["p1"] == "new"


def listing(posts, after=None):
    return json.dumps({"data": {"after": after, "children": [{"data": p} for p in posts]}})


def envelope(nodes):
    return json.dumps([{"kind": "Listing"}, {"data": {"children": nodes}}])


def test_listing_with_empty_and_broken_pages(spark):
    bodies = [listing([post(1), post(2)], "t3_x"), listing([]), "{broken", None]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    rows = listings.unnest_listing(pages).orderBy("position").collect()
    assert [(r.page, r.position, r.after, r.id) for r in rows] == [
        (0, 0, "t3_x", "p1"),
        (0, 1, "t3_x", "p2"),
    ]


def test_envelope_keeps_comments_with_text(spark):
    nodes = [
        {"kind": "t1", "data": comment(1, None, replies="")},
        {"kind": "more", "data": {"id": "m", "body": "not a comment"}},
        {"kind": "t1", "data": comment(2, None, body=" [deleted]\n")},
        {"kind": "t1", "data": {"id": "nobody"}},
        {"kind": "t1", "data": comment(3, None, body=None)},
        {"kind": "t1", "data": comment(4, None, score=None)},
    ]
    envelopes = spark.createDataFrame(
        [("p1", envelope(nodes)), ("p2", "[{}]"), ("p3", "nonsense"), ("p4", None)],
        "post_id string, body string",
    )
    rows = listings.unnest_comments(envelopes).collect()
    assert {(r.id, r.parent_post_id) for r in rows} == {("c1", "p1"), ("c4", "p1")}
    assert listings.unnest_comments(envelopes, limit=5).count() == 1
    assert listings.unnest_comments(envelopes, limit=None).count() == 2


def landed(spark, posts):
    pages = [("f", n, listing([p])) for n, p in enumerate(posts)]
    envelopes = [
        (p["id"], envelope([{"kind": "t1", "data": comment(0, None, id="c" + p["id"])}])) for p in posts
    ]
    return (
        spark.createDataFrame(pages, "forum string, page int, body string"),
        spark.createDataFrame(envelopes, "post_id string, body string"),
    )


def test_incremental_runs(spark, tmp_path):
    root = str(tmp_path / "root")
    as_of = datetime(2024, 1, 1)
    # The listing is not in time order and holds a post without text.
    first = [post(3), post(9, selftext="short"), post(1), post(2)]
    pages, envelopes = landed(spark, first)
    assert ingest.run_ingest(spark, pages, envelopes, root, "r1", max_posts=2, as_of=as_of)
    got = files.read_posts(spark, f"{root}/posts/run=r1")
    assert {r.id for r in got.collect()} == {"p3", "p1"}
    marks = state.read_watermarks(spark, f"{root}/state/watermarks").collect()
    # The watermark stays below the post that the cap left out.
    assert [(m.subreddit, m.last_ingested_utc) for m in marks] == [
        ("f", datetime(1970, 1, 1, 0, 16, 41))
    ]

    # The next run finds that post; the known ones do not use up its cap.
    assert ingest.run_ingest(spark, pages, envelopes, root, "r2", max_posts=1, as_of=as_of)
    assert [r.id for r in files.read_posts(spark, f"{root}/posts/run=r2").collect()] == ["p2"]
    assert not ingest.run_ingest(spark, pages, envelopes, root, "r2b", as_of=as_of)

    pages, envelopes = landed(spark, [post(3), post(4), post(0), post(5, subreddit="g")])
    assert ingest.run_ingest(spark, pages, envelopes, root, "r3", as_of=as_of)
    comments = files.read_comments(spark, f"{root}/comments/*")
    assert {r.parent_post_id for r in comments.collect()} == {"p1", "p2", "p3", "p4", "p5"}
    # Repeating a finished run changes nothing.
    assert ingest.run_ingest(spark, pages, envelopes, root, "r3", as_of=as_of)
    assert files.read_posts(spark, f"{root}/posts/*").count() == 5
    marks = state.read_watermarks(spark, f"{root}/state/watermarks")
    assert {(m.subreddit, m.last_ingested_utc.second) for m in marks.collect()} == {
        ("f", 44),
        ("g", 45),
    }


def test_a_cap_loses_no_post(spark, tmp_path):
    root = str(tmp_path / "root")
    pages, envelopes = landed(spark, [post(200), post(100)])
    for run, cap in (("a", 1), ("b", 1), ("c", None)):
        ingest.run_ingest(spark, pages, envelopes, root, run, max_posts=cap)
    assert {r.id for r in files.read_posts(spark, f"{root}/posts/*").collect()} == {"p100", "p200"}


def test_a_failed_run_starts_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    pages, envelopes = landed(spark, [post(1), post(2)])

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.state_sinks, "add_completed", fail)
        with pytest.raises(RuntimeError):
            ingest.run_ingest(spark, pages, envelopes, root, "r1")
    assert ingest.run_ingest(spark, pages, envelopes, root, "r1")
    assert files.read_posts(spark, f"{root}/posts/*").count() == 2
    assert files.read_comments(spark, f"{root}/comments/*").count() == 2


def test_resume_from_progress_files(spark, tmp_path):
    root = str(tmp_path / "root")
    write_json(
        tmp_path / "progress/f_comment_progress.json",
        {
            "completed_post_ids": ["p1"],
            "comments": [comment(7, "p1")],
            "saved_at": "2024-01-01T00:00:00+00:00",
            "status": "in_progress",
        },
    )
    (tmp_path / "progress/g_comment_progress.json").write_text("{broken")
    pages, envelopes = landed(spark, [post(1), post(2)])
    progress = str(tmp_path / "progress/*.json")
    assert ingest.run_ingest(spark, pages, envelopes, root, "r1", progress=progress)
    rows = files.read_comments(spark, f"{root}/comments/*").collect()
    assert {(r.id, r.parent_post_id) for r in rows} == {("c7", "p1"), ("cp2", "p2")}
    done, fetched = state.read_progress(spark, str(tmp_path / "no/*.json"))
    assert done.count() == 0 and fetched.count() == 0


def test_progress_files_are_few(spark, tmp_path, monkeypatch):
    """A file per so many rows, not per page; a page of many comments, or none known, loses nothing."""
    monkeypatch.setattr(ingest_queries, "PROGRESS_ROWS", 50, raising=False)
    monkeypatch.setattr(ingest_queries, "work_dir", lambda *_: str(tmp_path / "progress"))
    spark.range(300).selectExpr("if(id = 7, null, id * 50) as doc_id").write.parquet(str(tmp_path / "labels.parquet"))
    turns = "case when id < 250 then id when id < 450 then 3 end as conv_id, cast(id as int) as turn, 'user' as role, 'text' as text"
    spark.range(460).selectExpr(*turns.split(", ")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((r.kind, str(r.id)) for r in ingest_queries.progress_files(spark, str(tmp_path)).collect())
    want = [("done", str(n * 50)) for n in range(300) if n != 7]
    want += [("comment", f"{n if n < 250 else 3}_{n}" if n < 450 else "None") for n in range(460)]
    assert got == sorted(want)
    assert len(list((tmp_path / "progress").rglob("part-*"))) <= 16


def test_watermark_state(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert state.read_watermarks(spark, path).count() == 0

    def marks(*rows):
        frame = spark.createDataFrame(rows, "subreddit string, last_ingested_utc timestamp_ntz")
        return frame.withColumn("last_ingested_utc", F.col("last_ingested_utc").cast("timestamp"))

    late, early = datetime(2024, 1, 2, 3, 4, 5, 600000), datetime(2024, 1, 1)
    assert state_sinks.upsert_watermarks(spark, path, marks(("f", late), ("g", early)), "a", early) == 0
    for _ in range(2):  # a repeat replaces its version
        moved = marks(("f", early), ("h", late))
        assert state_sinks.upsert_watermarks(spark, path, moved, "b", late) == 1
    got = state.read_watermarks(spark, path)
    seconds = late.replace(microsecond=0)
    assert {(r.subreddit, r.last_ingested_utc, r.updated_at) for r in got.collect()} == {
        ("f", seconds, seconds),
        ("g", early, early),
        ("h", seconds, seconds),
    }
    for n in range(3):
        state_sinks.upsert_watermarks(spark, path, marks(("f", late)), f"c-{n}", late, keep=2)
    assert sorted(p.name for p in (tmp_path / "marks").iterdir()) == [
        "version=000003-c-1",
        "version=000004-c-2",
    ]
    assert state.read_watermarks(spark, path).count() == 3
    # A version that was not finished does not count.
    (tmp_path / "marks/version=000005-d").mkdir()
    assert state.read_watermarks(spark, path).count() == 3

    write_json(
        tmp_path / "json/f_watermark.json",
        {
            "subreddit": "f",
            "last_ingested_utc": "2024-01-02T03:04:05Z",
            "updated_at": "2024-01-02T03:04:05Z",
        },
    )
    (tmp_path / "json/g_watermark.json").write_text("{")
    rows = state.read_watermark_json(spark, str(tmp_path / "json/*.json")).collect()
    assert [(r.subreddit, r.last_ingested_utc) for r in rows] == [("f", seconds)]
    assert state.read_watermark_json(spark, str(tmp_path / "none/*")).count() == 0


def test_index_and_retrieval(spark, tmp_path):
    def mart(*rows):
        schema = (
            "post_id string, post_title string, post_body string, post_author string, "
            "link_flair_text string, subreddit string, post_url string, "
            "post_created_at timestamp_ntz, comment_id string, comment_body string, "
            "comment_author string, comment_parent_id string, comment_permalink string"
        )
        return spark.createDataFrame(rows, schema)

    def row(n, body, day, comment_body=None):
        return (
            f"p{n}", "T", body, "ann", None, "f", "u", datetime(2024, 1, day),
            f"c{n}" if comment_body else None, comment_body, "bob", f"t3_p{n}", "/c",
        )

    as_of = datetime(2024, 1, 31)
    path = str(tmp_path / "index")
    first = mart(row(1, "cats like milk", 20, "dogs like bones"), row(2, "too old", 1))
    index.update_index(spark, index.chunks_to_index(first, as_of, 14), path, "a")
    assert {r.doc_id for r in spark.read.parquet(path).collect()} == {"p1", "c1"}

    both = first.unionByName(mart(row(3, "cars need fuel", 25)))
    for _ in range(2):  # a repeated run replaces its own part
        index.update_index(spark, index.chunks_to_index(both, as_of, 14), path, "b")
    stored = spark.read.parquet(path)
    assert {(r.doc_id, r.run) for r in stored.collect()} == {("p1", "a"), ("c1", "a"), ("p3", "b")}

    questions = spark.createDataFrame(
        [("q1", "do dogs like bones"), ("q2", "nothing alike")],
        "question_id string, question string",
    )
    hits = index.retrieve(stored, questions, k=2, min_score=0.4)
    found = {(r.question_id, r["rank"]): r.doc_id for r in hits_with_doc(hits).collect()}
    assert found == {("q1", 1): "c1"}
    context = index.answer_context(hits).collect()
    assert [(r.question_id, r.context) for r in context] == [("q1", "dogs like bones")]


def test_retrieval_of_all_hits(spark):
    """Without a limit the rows and columns of a limit that is never reached; a smaller one cuts them."""
    texts = [(f"c{n}", f"dogs like {n % 7} bones", {"n": str(n)}) for n in range(40)] + [("x", "cars need fuel", {})]
    chunks = spark.createDataFrame(texts, "chunk_id string, chunk_text string, metadata map<string, string>")
    held = embedding.embed_chunks(chunks)
    asked = [("q1", "do dogs like bones"), ("q2", "fuel"), ("q3", "nothing alike"), ("q4", None)]
    questions = spark.createDataFrame(asked, "question_id string, question string")
    every = index.retrieve(held, questions, k=None, min_score=0.4)
    best = index.retrieve(held, questions, k=1000, min_score=0.4)
    assert every.dtypes == best.dtypes
    assert sorted(map(str, every.collect())) == sorted(map(str, best.collect()))
    assert every.count() == 41 and index.retrieve(held, questions, k=39, min_score=0.4).count() == 40


def hits_with_doc(hits):
    return hits.withColumn("doc_id", F.col("metadata")["COMMENT_ID"])


def test_corpus_ids_are_unique(spark, raw):
    posts = transform.transform_posts(files.read_posts(spark, f"{raw}/posts/*", True))
    comments = transform.transform_comments(files.read_comments(spark, f"{raw}/comments/*", True))
    mart = transform.build_mart(transform.stage_posts(posts), transform.stage_comments(comments))
    chunks = chunking.with_chunk_id(chunking.corpus(mart))
    assert chunks.count() == chunks.select("chunk_id").distinct().count() == 5
