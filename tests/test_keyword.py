"""Ranked keyword search against scoring by hand."""

import math

import pytest

from threadloom.operators import keyword

DOCS = [(1, "the cat sat on the mat"), (2, "The dog\tate the cat"), (3, "dogs and cats"), (4, ""), (5, None), (6, "the " * 50), (7, "cat cat"), (8, "Élan élan")]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("keywords"))
    keyword.build_index(spark.createDataFrame([*DOCS, (None, "cat")], "doc_id long, text string"), folder, "doc_id", "text", buckets=8)
    return folder


def by_hand(question, k):
    texts = {i: (t or "").lower().split() for i, t in DOCS}
    mean, out = sum(map(len, texts.values())) / len(texts), []
    for i, own in texts.items():
        score = 0.0
        for w in set(question.lower().split()):
            df, tf = sum(w in x for x in texts.values()), own.count(w)
            if tf:
                score += math.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))
        if score:
            out.append((-round(score, 6), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


def test_scores_by_hand(spark, path):
    asked = {1: "the cat", 2: "cat cat DOG", 3: "unknown", 4: "", 5: "élan", 6: None}
    questions = spark.createDataFrame([*asked.items(), (None, "cat")], "question_id int, question string")
    found = keyword.search(spark, path, questions, 3).orderBy("question_id", "rank").collect()
    for q, text in asked.items():
        assert [(r["match_id"], pytest.approx(r["score"])) for r in found if r["question_id"] == q] == by_hand(text or "", 3)
    assert {r["question_id"] for r in found} == {1, 2, 5}


def test_only_the_asked_buckets_are_read(spark, path):
    questions = spark.createDataFrame([(1, "cat")], "question_id int, question string")
    plan = keyword.search(spark, path, questions)._jdf.queryExecution().executedPlan().toString()
    bucket = spark.createDataFrame([("cat",)], "term string").select(keyword._bucket("term", 8)).first()[0]
    assert f"PartitionFilters: [isnotnull(bucket" in plan and f"(bucket" in plan and f"= {bucket})" in plan


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    keyword.build_index(docs, str(tmp_path), "doc_id", "text")
    questions = spark.createDataFrame([(1, "cat")], "question_id int, question string")
    assert keyword.search(spark, str(tmp_path), questions).count() == 0
    keyword.build_index(docs.union(spark.createDataFrame([(1, "cat"), (1, "cat dog")], docs.schema)), str(tmp_path), "doc_id", "text")
    assert [(r["match_id"], r["rank"]) for r in keyword.search(spark, str(tmp_path), questions).collect()] == [(1, 1)]
    assert keyword.search(spark, str(tmp_path), questions.limit(0)).count() == 0


def test_shared_ids_are_one_document_and_no_pair_is_shuffled(spark, tmp_path):
    """Two rows of an id count together; what a search shuffles does not grow with the questions."""
    docs = [(n % 30, f"word{n % 7} word{n % 5} word{n % 3} all") for n in range(40)]
    folder = str(tmp_path / "keywords")
    keyword.build_index(spark.createDataFrame(docs, "doc_id long, text string"), folder, "doc_id", "text", buckets=4)
    texts = {i: " ".join(t for j, t in docs if j == i).split() for i in range(30)}
    mean = sum(map(len, texts.values())) / 30
    questions = [(q, f"all word{q % 8} word{q % 4}") for q in range(50)]
    hits = keyword.search(spark, folder, spark.createDataFrame(questions, "question_id long, question string"), k=4)
    want = set()
    for q, text in questions:
        scores = {}
        for term in set(text.split()):
            df = sum(term in words for words in texts.values())
            for i, words in texts.items():
                tf = words.count(term)
                part = math.log(1 + (30 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
                if tf:
                    scores[i] = scores.get(i, 0) + part
        best = sorted((-round(s, 6), i) for i, s in scores.items())[:4]
        want |= {(q, i, -s, rank) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in hits.collect()} == want
    assert "HashAggregate(keys=[question_id" not in hits._jdf.queryExecution().executedPlan().toString()
