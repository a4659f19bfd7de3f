import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import embedding, similarity


def brute_force(corpus, questions, k, min_score):
    """Every pair scored and sorted, one question at a time."""
    out = set()
    for q, qv in questions:
        scored = []
        for c, cv in corpus:
            scale = np.linalg.norm(qv) * np.linalg.norm(cv)
            score = round(float(np.dot(qv, cv) / scale), 6) if scale else 0.0
            if min_score is None or score >= min_score:
                scored.append((-score, c))
        for rank, (negative, c) in enumerate(sorted(scored)[:k], 1):
            out.add((q, c, -negative + 0.0, rank))
    return out


def vectors(rng, n, dims):
    rows = rng.integers(-3, 4, size=(n, dims)).astype(float)
    rows[0] = 0.0
    rows[n // 3 : 2 * n // 3] = rows[n // 3]  # a third of the rows are copies
    return rows.tolist()


PATHS = [
    {},
    {"max_broadcast_floats": 7},
    {"max_broadcast_floats": 40},
]


@pytest.mark.parametrize("options", PATHS)
@pytest.mark.parametrize("min_score", [None, -0.5, 0.0, 0.4, 0.9])
def test_top_k_equals_brute_force(spark, options, min_score):
    rng = np.random.default_rng(5)
    corpus = [(f"c{n:03d}", v) for n, v in enumerate(vectors(rng, 60, 4))]
    questions = [(n, v) for n, v in enumerate(vectors(rng, 15, 4))]
    got = similarity.top_k(
        spark.createDataFrame(corpus, "chunk_id string, embedding array<float>").repartition(5),
        spark.createDataFrame(questions, "question_id long, embedding array<double>"),
        k=3,
        min_score=min_score,
        **options,
    )
    rows = {(r.question_id, r.match_id, r.score, r["rank"]) for r in got.collect()}
    assert rows == brute_force(corpus, questions, 3, min_score)


@pytest.mark.parametrize("cell_floats", [2_000_000, 16])
@pytest.mark.parametrize("options", PATHS[:2])
@pytest.mark.parametrize("min_score", [None, 0.0, 0.4])
def test_every_hit_equals_brute_force(spark, monkeypatch, options, min_score, cell_floats):
    """No limit: also a row that many questions ask for and a question that many copies answer; the rows keep their columns."""
    monkeypatch.setattr(similarity, "CELL_FLOATS", cell_floats)
    rng = np.random.default_rng(7)
    corpus = [(f"c{n:03d}", v, {"n": str(n)}) for n, v in enumerate(vectors(rng, 60, 4))]
    questions = [(n, v) for n, v in enumerate(vectors(rng, 15, 4))]
    none = [("x", None, None), (None, [1.0, 1.0, 1.0, 1.0], None)]
    got = similarity.every_hit(
        spark.createDataFrame(corpus + none, "match_id string, embedding array<float>, metadata map<string, string>").repartition(5),
        spark.createDataFrame([*questions, (99, None), (None, [1.0] * 4)], "question_id long, embedding array<double>"),
        min_score,
        **options,
    )
    assert got.columns == ["match_id", "metadata", "question_id", "score"]
    rows = sorted((r.question_id, r.match_id, r.score, int(r.metadata["n"])) for r in got.collect())
    want = brute_force([c[:2] for c in corpus], questions, 1000, min_score)
    assert rows == sorted((q, c, score, int(c[1:])) for q, c, score, _ in want)


def test_every_hit_of_many_questions_in_parts_of_a_batch(spark):
    """A batch of rows makes more scores than are made at once."""
    angle = F.col("id") * 0.01
    rows = spark.range(0, 2500, 1, 1).select(F.col("id").alias("match_id"), F.array(F.cos(angle), F.sin(angle)).alias("embedding"))
    asked = rows.where("match_id < 700").withColumnRenamed("match_id", "question_id")
    assert 2000 * 700 > similarity.HITS_AT_ONCE
    got = similarity.every_hit(rows, asked, 0.9).groupBy().agg(F.count("*"), F.sum(F.col("match_id") * F.col("question_id"))).first()
    angles = np.arange(2500) * 0.01
    question, match = np.nonzero(np.round(np.cos(angles[:700, None] - angles[None]), 6) >= 0.9)
    assert tuple(got) == (len(match), int((question * match).sum()))


@pytest.mark.parametrize("options", PATHS[:2])
def test_every_hit_of_empty_sides_and_other_sizes(spark, options):
    one = spark.createDataFrame([(1, [1.0])], "question_id long, embedding array<double>")
    chunks = one.select(F.col("question_id").alias("match_id"), "embedding")
    assert similarity.every_hit(chunks.where("match_id < 0"), one, **options).count() == 0
    assert similarity.every_hit(chunks, one.where("question_id < 0"), **options).count() == 0
    assert [tuple(r) for r in similarity.every_hit(chunks, one, **options).collect()] == [(1, 1, 1.0)]
    mixed = spark.createDataFrame([(7, [1.0] * 8), (8, [1.0])], "match_id long, embedding array<double>")
    asked = one.select("question_id", F.array_repeat(F.lit(1.0), 8).alias("embedding"))
    with pytest.raises(Exception, match="the vector of 8 has not 8 elements"):
        similarity.every_hit(mixed, asked, **options).collect()


@pytest.mark.parametrize("options", PATHS[:2])
def test_copies_and_unusable_vectors(spark, options):
    copies = [(n, [1.0, 1.0]) for n in range(40)]
    odd = [(100, [float("nan"), 1.0]), (101, [0.0, 0.0]), (102, [float("inf"), 0.0])]
    corpus = spark.createDataFrame(
        [*copies, *odd, (103, None), (104, [1.0, 0.0])], "chunk_id long, embedding array<double>"
    )
    asked = spark.createDataFrame(
        [("a", [2.0, 2.0]), ("b", [3.0, 0.0]), ("c", None)],
        "question_id string, embedding array<float>",
    )
    got = similarity.top_k(corpus, asked, k=3, min_score=0.5, **options).collect()
    assert sorted((r.question_id, r["rank"], r.match_id, r.score) for r in got) == [
        ("a", 1, 0, 1.0),
        ("a", 2, 1, 1.0),
        ("a", 3, 2, 1.0),
        ("b", 1, 104, 1.0),
        ("b", 2, 0, 0.707107),
        ("b", 3, 1, 0.707107),
    ]


@pytest.mark.parametrize("options", PATHS[:2])
def test_empty_sides(spark, options):
    one = spark.createDataFrame([(1, [1.0])], "question_id long, embedding array<double>")
    chunks = one.select(F.col("question_id").alias("chunk_id"), "embedding")
    none = chunks.where("chunk_id < 0")
    assert similarity.top_k(none, one, **options).count() == 0
    assert similarity.top_k(chunks, one.where("question_id < 0"), **options).count() == 0
    assert similarity.top_k(chunks, one, **options).count() == 1


def test_vectors_of_other_sizes_fail_by_name(spark):
    schema = "chunk_id long, embedding array<double>"
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "question_id long, embedding array<double>")
    mixed = spark.createDataFrame([(7, [1.0, 0.0, 0.0]), (8, [1.0, 0.0])], schema)
    with pytest.raises(Exception, match="the vector of 8 has not 3 elements"):
        similarity.top_k(mixed, asked).collect()
    both = asked.unionByName(spark.createDataFrame([(2, [1.0])], asked.schema))
    with pytest.raises(ValueError, match="1 to 3 elements"):
        similarity.top_k(mixed, both)


def test_null_ids_take_no_part_and_large_ids_stay(spark):
    big = 2**53 + 1
    corpus = spark.createDataFrame([(big, [1.0, 0.0]), (None, [1.0, 0.0])], "chunk_id long, embedding array<double>")
    asked = spark.createDataFrame([(big, [1.0, 0.0]), (None, [1.0, 0.0])], "question_id long, embedding array<double>")
    assert [(r.question_id, r.match_id) for r in similarity.top_k(corpus, asked).collect()] == [(big, big)]


@pytest.mark.parametrize("options", PATHS)
def test_every_text_is_embedded_once(spark, options):
    calls = spark.sparkContext.accumulator(0)

    def provider():
        def embed(texts):
            calls.add(len(texts))
            return np.array([[len(t), 1.0] for t in texts])

        return embed

    def embedded(n, key):
        rows = spark.range(n).select(F.col("id").alias(key), F.repeat(F.lit("a"), F.col("id").cast("int")).alias("chunk_text"))
        return embedding.embed_chunks(rows, provider)

    assert similarity.top_k(embedded(30, "chunk_id"), embedded(8, "question_id"), k=2, min_score=None, **options).count() == 16
    assert calls.value == 38


def test_questions_in_blocks_stay_off_the_driver(spark, monkeypatch):
    """More blocks of questions make neither more jobs nor a frame that the driver collects."""
    monkeypatch.setattr(similarity, "CELL_FLOATS", 60, raising=False)
    rng = np.random.default_rng(6)
    rows = [(n, v) for n, v in enumerate(vectors(rng, 60, 4))]
    frame = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    asked = frame.withColumnRenamed("chunk_id", "question_id")
    monkeypatch.setattr(type(frame), "toArrow", lambda self: pytest.fail("collected"))
    jobs = []
    for floats in (120, 4):
        spark.sparkContext.setJobGroup(f"blocks-{floats}", "")
        got = {tuple(r) for r in similarity.top_k(frame, asked, k=3, min_score=0.4, max_broadcast_floats=floats).collect()}
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"blocks-{floats}")))
        assert got == brute_force(rows, rows, 3, 0.4)
    assert jobs[1] <= jobs[0] + 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hashing_provider():
    embed = embedding.hashing_provider(16)
    a, b, empty = embed(["One two two", "two  one TWO", " "])
    assert np.allclose(a, b) and np.isclose(np.linalg.norm(a), 1.0)
    assert not empty.any()


def test_built_in_vectors_are_those_of_the_provider(spark):
    texts = ["One two two", "  two  one TWO ", " ", "", None, "Ünïcode wörds, and 日本 🙂", "a " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, chunk_text string")
    frame = embedding.embed_chunks(df)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    got = {r.n: r.embedding for r in frame.collect()}
    want = embedding.hashing_provider()([t or "" for t in texts])
    assert got[4] is None
    assert all(np.allclose(got[n], want[n], atol=1e-7) for n in got if n != 4)


def test_provider_is_set_up_per_task_and_nulls_stay_null(spark):
    def provider():
        seen = []

        def embed(texts):
            seen.append(len(texts))
            assert len(texts) <= 2
            return np.array([[len(t), len(seen)] for t in texts], dtype=float)

        return embed

    df = spark.createDataFrame(
        [(1, "a"), (2, None), (3, "ccc"), (4, "dd"), (5, "")], "n int, chunk_text string"
    ).coalesce(1)
    vectors = df.select("n", embedding.embed_column(F.col("chunk_text"), provider, 2).alias("v"))
    got = {r.n: r.v for r in vectors.collect()}
    assert got == {1: [1.0, 1.0], 2: None, 3: [3.0, 1.0], 4: [2.0, 2.0], 5: [0.0, 2.0]}
