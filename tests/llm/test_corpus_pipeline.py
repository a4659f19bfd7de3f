"""The pipeline on a small table: each stage's kept rows, and rows that are easy to trip over."""

import random

import corpus_pipeline
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the river was old and people of the town had lived by it for as long as anyone could say".split(),
    "de": "der Fluss war alt und die Leute der Stadt hatten an ihm gelebt solange man denken konnte".split(),
}
ITEM = "A farmer near Leeds sold 24 sheep and bought 3 cows before the market closed at noon on Friday last week"


def prose(rng, lang, n=60):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "n"]) for _ in range(n))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(2)
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(k, prose(rng, lang), lang, f"s{k % 12}") for k, lang in enumerate(["en", "de"] * 60)]
    shared = "Read more of this on our pages"
    rows += [(200 + k, f"{prose(rng, 'en')}\n{shared}\n", "en", f"s{k}") for k in range(12)]
    copied = prose(rng, "de")
    rows += [(300 + k, copied, "de", "s1") for k in range(30)] + [(340, copied.replace("Stadt", "STADT"), "de", "s2")]
    rows += [(400, f"{prose(rng, 'en')} {ITEM} {prose(rng, 'en')}", "en", "s1")]
    rows += [(401, f"{prose(rng, 'en')} {ITEM.replace('24', '31').replace('Leeds', 'York')} {prose(rng, 'en')}", "en", "s1")]
    rows += [(500, None, "en", "s1"), (501, "", None, None), (502, "12 34 56", "en", "s1")]
    rows += [(None, prose(rng, "en"), "en", "s3"), (None, prose(rng, "en"), None, None)]
    rows += [(600, (again := prose(rng, "en")), "en", "s3"), (600, again, "en", "s3"), (601, prose(rng, "en", 30_000), "en", "s4")]
    docs = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    kept["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != "pieces":
            assert docs.schema.names == [c.split()[0] for c in DOCS.split(", ")]
    return kept, folder


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_language_drops_only_what_it_cannot_tell(stages):
    kept, _ = stages
    assert ids(kept["input"]) - ids(kept["language"]) == {500, 501, 502}
    assert len(kept["input"]) - len(kept["language"]) == 3


def test_shared_lines_go_and_no_document(stages):
    kept, _ = stages
    assert len(kept["shared lines"]) == len(kept["language"])
    assert not any("Read more" in r["text"] for r in kept["shared lines"])
    assert all(r["n_chars"] == len(r["text"]) for r in kept["shared lines"])


def test_one_of_each_group_of_copies_stays(stages):
    kept, _ = stages
    gone = ids(kept["shared lines"]) - ids(kept["near copies"])
    assert gone == set(range(301, 330)) | {340}
    assert sum(r["doc_id"] is None for r in kept["near copies"]) == 2 and sum(r["doc_id"] == 600 for r in kept["near copies"]) == 2


def test_leaks_go_also_with_other_values(stages):
    kept, _ = stages
    assert ids(kept["near copies"]) - ids(kept["benchmark leaks"]) == {400, 401}


def test_all_that_is_left_is_encoded_without_loss(stages):
    kept, _ = stages
    assert len(kept["pieces"]) == len(kept["benchmark leaks"])
    assert all(r["lossless"] and r["piece_ids"] for r in kept["pieces"])


def test_run_gives_the_last_stage(spark, stages):
    kept, folder = stages
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, kept["pieces"]))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
