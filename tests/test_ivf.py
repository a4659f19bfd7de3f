"""Inverted-file search against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import ivf, similarity

SCHEMA = "chunk_id long, embedding array<float>"


def rows_of(seed, n, dims, groups=20, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(k, (centres[k % groups] + spread * rng.normal(size=dims)).tolist()) for k in range(n)]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    rows = rows_of(1, 3000, 12)
    rows += [(3000 + k, rows[k][1]) for k in range(200)] + [(4000, [0.0] * 12), (4001, [0.0] * 12), (4002, None), (None, rows[0][1])]
    path = str(tmp_path_factory.mktemp("ivf"))
    corpus = spark.createDataFrame(rows, SCHEMA)
    ivf.build_index(corpus, path, cells=40)
    asked = spark.createDataFrame([(k, v) for k, v in rows_of(2, 90, 12) + [(90, [0.0] * 12), (91, None)]] + rows[:30], "question_id long, embedding array<float>")
    asked = asked.withColumn("question_id", F.monotonically_increasing_id())
    return path, corpus, asked


def bag(df):
    return sorted((r["question_id"], r["rank"], r["match_id"], r["score"]) for r in df.collect())


def test_every_row_is_in_the_index(spark, clustered):
    path, corpus, _ = clustered
    cells = ivf.read_cells(spark, path)
    index = spark.read.parquet(f"{path}/vectors")
    assert cells.rows.sum() == index.count() == 3202 and cells.rows[cells.numbers == ivf.NO_DIRECTION] == [2]
    units = similarity._unit_rows(index.toArrow()["vec"])
    own = np.array([r["cell"] for r in index.select("cell").collect()])
    bounds = cells.bounds(units[:50])
    scores = units[:50] @ units.T
    for place, number in enumerate(cells.numbers):
        assert (scores[:, own == number] <= bounds[:, place, None] + 1e-9).all()


@pytest.mark.parametrize("floats,min_score", [(similarity.MAX_BROADCAST_FLOATS, 0.3), (300, None)])
def test_a_completed_search_is_the_exact_one(spark, clustered, floats, min_score):
    path, corpus, asked = clustered
    exact = similarity.top_k(corpus, asked, 5, min_score)
    found = ivf.search(spark, path, asked, 5, min_score, probes=2, complete=True, max_broadcast_floats=floats)
    assert bag(found.hits) == bag(exact)


def test_only_probed_cells_are_read(spark, clustered):
    path, corpus, asked = clustered
    one = asked.where(F.col("embedding").isNotNull()).limit(1)
    found = ivf.search(spark, path, one, 5, 0.3, probes=3)
    assert 0 < found.share_read < 0.25
    cells = ivf.read_cells(spark, path)
    table = one.select(F.col("question_id").alias("id"), F.col("embedding").alias("vec"), F.array(F.lit(0), F.lit(1)).alias("asks")).toArrow()
    scan, _ = ivf._scan(ivf.read_vectors(spark, path), table, cells, similarity._result_schema(one.schema["question_id"], corpus.schema["chunk_id"]), 5, 0.3)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "ReadSchema: struct<id:bigint,vec:array<float>>" in plan


def test_probes_rise_until_the_recall_is_reached(spark, clustered):
    path, corpus, asked = clustered
    found, probes = ivf.audited_search(spark, path, asked, asked, 5, 0.3, probes=1)
    exact = similarity.top_k(corpus, asked, 5, 0.3)
    assert ivf.recall(found.hits, exact).agg(F.avg("recall")).first()[0] >= 0.95 and 0 < probes < 40
    all_of_it, probes = ivf.audited_search(spark, path, asked, asked, 5, 0.3, probes=1, min_recall=1.1)
    assert probes == 0 and bag(all_of_it.hits) == bag(exact)


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    ivf.build_index(empty, f"{tmp_path}/none")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, embedding array<float>")
    assert ivf.search(spark, f"{tmp_path}/none", asked, complete=True).hits.count() == 0
    ivf.build_index(spark.createDataFrame([(1, [2.0, 0.0]), (2, [2.0, 0.0])], SCHEMA), f"{tmp_path}/same", cells=2)
    assert bag(ivf.search(spark, f"{tmp_path}/same", asked, 1, complete=True).hits) == [(1, 1, 1, 1.0)]
    assert ivf.search(spark, f"{tmp_path}/same", asked.limit(0)).hits.count() == 0
    with pytest.raises(ValueError):
        ivf.build_index(spark.createDataFrame([(1, [2.0]), (2, [2.0, 0.0])], SCHEMA), f"{tmp_path}/mixed")
    with pytest.raises(ValueError):
        ivf.search(spark, f"{tmp_path}/same", spark.createDataFrame([(1, [1.0])], "question_id long, embedding array<float>"))
