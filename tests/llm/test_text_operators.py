"""HTML, pieces, language, lines, URLs, toxicity and decontamination."""

import random
import re
import time

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from threadloom.llm import catalog, decontamination, html_text, language, line_dedup, pieces, toxicity, url_filter

SF_DIR = "/root/testdata/sf0.01"

ARTICLE = (
    "The river and the town were old, and the people of the town had lived by the river for as long as anyone "
    "could say. In the spring the water rose to the walls, and it was the work of all to keep it from the houses."
)


def page(body, head="<title>Not this</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body,text",
    [
        (f"<nav><a href=x>Home</a></nav><article><h1>Old &amp; new</h1><p>{ARTICLE}</p><p>Short end.</p></article><footer>&copy; us</footer>", f"Old & new {ARTICLE} Short end."),
        (f"<header><h2>Site</h2></header><main><header><h1>Head</h1></header><p>{ARTICLE}</p><aside>{ARTICLE}</aside></main>", f"Head {ARTICLE}"),
        (f"<article><p>{ARTICLE}</p><div class='ad-box'>{ARTICLE}</div><form><p>{ARTICLE}</p></form></article><div id=comments><article><p>{ARTICLE}</p></article></div>", ARTICLE),
        (f"<div class='cookie-notice'>{ARTICLE}</div><div class=content><h1>Head line</h1><p>{ARTICLE}</p><p>Tiny.</p><p>{ARTICLE}</p></div><div class=sidebar><p>{ARTICLE}</p></div>", f"Head line {ARTICLE} Tiny. {ARTICLE}"),
        (f"<article><script>var t='</p><p>{ARTICLE}';</script><p>A&nbsp;b\n\t c&#8217;s <b>bo</b>ld<br>x</p><!-- <p>no</p> --><p>{ARTICLE}", f"A b c’s bold x {ARTICLE}"),
        (f"<ul><li><a href=1>The one and the other</a><li><a href=2>And the next of the lot</a></ul><p>{ARTICLE}</p>", ARTICLE),
        ("", ""),
        ("<p>", ""),
        ("<div><a href=x>only links</a></div>", ""),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(page(body)) == text


@pytest.mark.parametrize(
    "page", ["<div>x " * 200_000, "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 50_000 + "<li>y" * 50_000, "<p>" * 100_000, "<b>" * 50_000 + "<p>z</h1>" * 50_000, "<option>" * 100_000 + "<p>" * 50_000]
)
def test_deep_pages_take_linear_time(page):
    begun = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begun < 10


@pytest.mark.parametrize("sentence", ["日本の川は古く、町の人々は長くその岸に住んでいた。", "Река была старой, и люди города жили у неё много лет. ", "Ο ποταμός ήταν παλιός και οι άνθρωποι ζούσαν εκεί. "])
def test_scripts_without_stop_words(sentence):
    body = f"<div><a href=x>{sentence * 4}</a></div><div><p>{sentence * 20}</p><p>{sentence}</p></div><div class=footer>{sentence * 9}</div>"
    assert html_text.main_text(page(body)) == f"{(sentence * 20).strip()} {sentence.strip()}"


def test_extraction_of_odd_pages(spark):
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (2, "u", "<p", "c"), (None, "v", "<<<>>> a < b", "d"), (5, "w", page(f"<p>{ARTICLE}</p>" * 3000), "e")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["id"]: r["n_chars"] for r in got}[5] == 3000 * (len(ARTICLE) + 1) - 1
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_extraction_takes_the_article_of_every_page(spark):
    for r in catalog.op1_html_extraction(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.DOTALL)[1]
        assert r["text"].replace(" ", "") == "".join(html_text.html.unescape(re.sub("<[^>]+>", "", inner)).split())


TEXTS = ["", " ", "  a  b ", "\n\n", "日本語のテキスト", "é" * 300, "a" * 700 + " b", "🙂 ok\t z", "the " * 200, "abcabc" * 90, "x\x00y"]


def test_pieces_without_dropout_are_those_of_the_library():
    known = pieces.Pieces(open(pieces.MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    ids, bounds = pieces.Encoder(known, dropout=0.0)(TEXTS, np.arange(len(TEXTS)))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == library.encode(TEXTS)


def test_long_and_short_words_give_the_same_pieces(monkeypatch):
    encoder = pieces.Encoder(pieces.Pieces(open(pieces.MODEL, "rb").read()), seed=9, dropout=0.3)
    keys = np.arange(len(TEXTS))
    together = encoder(TEXTS, keys)
    monkeypatch.setattr(pieces, "LONG_WORD", 0)
    assert all(np.array_equal(a, b) for a, b in zip(together, encoder(TEXTS, keys), strict=True))


def test_long_texts_give_the_same_pieces_in_parts(monkeypatch):
    encoder = pieces.Encoder(pieces.Pieces(open(pieces.MODEL, "rb").read()), seed=9, dropout=0.3)
    texts = [*TEXTS, "a  bc   d " * 60, " " * 500, "no_space" * 50, " x" * 300]
    keys = np.arange(len(texts))
    whole = encoder(texts, keys)
    for step in (1, 7, 64):
        monkeypatch.setattr(pieces, "STEP", step)
        ids, bounds = pieces._segment(encoder, texts, keys)
        assert ids.tolist() == whole[0].tolist() and bounds.tolist() == whole[1].tolist()


def test_pieces_round_trip_and_vary_with_the_seed(spark):
    texts = [*TEXTS, "a ▁ b", "▁", None, "hello wonderful world " * 50]
    df = spark.createDataFrame([(k, t, "k", 7) for k, t in enumerate(texts)] + [(None, "hello", "k", 7)], "doc_id long, text string, KEY string, decoded int")
    for dropout in (0.0, 0.1, 1.0):
        both = pieces.decode(pieces.encode(df, dropout=dropout)).collect()
        assert len(both) == len(texts) + 1
        assert all(r["decoded"] == r["text"] and (r["piece_ids"] is None) == (r["text"] is None) and r["KEY"] == "k" for r in both)
    one, two, again = (
        [r["piece_ids"] for r in pieces.encode(df, seed=s).orderBy("doc_id").collect()] for s in (1, 2, 1)
    )
    assert one == again and one != two
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0


def test_language_is_told_on_held_out_texts(spark):
    got = catalog.op3_language_id(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held_out = [r for r in got if r["held_out"]]
    assert len(held_out) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held_out) >= 0.98 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(k, "the cat and the dog of the house" if k % 2 else "der Hund und die Katze", "en" if k % 2 else "de", "s") for k in range(30)]
    odd = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34 !?", "en", "s"), (None, "the dog and the cat", None, "s"), (104, "the dog " * 50_000, "en", "s")]
    df = spark.createDataFrame(rows + odd, schema)
    model = language.fit(df, F.col("doc_id") < 50)
    got = {r["doc_id"]: r for r in language.predict(df, model, into=("lang_pred", "sure")).collect()}
    assert [got[k]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3 and got[100]["sure"] == 0
    assert got[None]["lang_pred"] == got[104]["lang_pred"] == "en" and got[1]["score"] == "s"
    for own in (df.limit(0), df.where("lang = 'en' or lang is null")):
        told = language.predict(df, language.fit(own, F.lit(True))).collect()
        assert len(told) == len(rows) + len(odd)
        assert {r["lang_pred"] for r in told} <= {"en", "und"}


def test_shared_lines_go_and_copies_stay(spark):
    footer = "All rights reserved"
    rows = [(k, f"own line {k} of this text\n {footer} \n\nmore of {k}", f"site{k % 12}", "x") for k in range(24)]
    rows += [(100 + k, f"copied text one\ncopied text two\n{footer}", f"site{k}", "x") for k in range(12)]
    rows += [(200, None, "site1", "x"), (201, "", None, "x"), (202, f"own words, quite a lot of them\n{footer}", None, "x"), (None, f"{footer}\nand some other words here", "site3", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, gone string")
    got = {r["doc_id"]: r for r in line_dedup.strip_shared_lines(df).collect()}
    assert got[0]["text"] == "own line 0 of this text\n\nmore of 0" and got[0]["n_removed"] == 1 and got[0]["n_lines"] == 4
    assert got[100]["text"].startswith("copied text one") and got[100]["n_removed"] == 0
    assert got[200]["text"] is None and got[200]["n_lines"] == 0 and got[201]["text"] == ""
    assert got[202]["text"] == "own words, quite a lot of them" and got[None]["text"] == "and some other words here"
    assert got[5]["gone"] == "x"
    # However much of it is shared, a document with a line of its own loses the rest; rows without an id are no group.
    most = [(300, "\n".join(["copied text one"] * 50 + [" mine", "  "]), "site1", "x"), (None, f"{footer}\n", "site1", "x"), (None, "one more", None, "x")]
    more = [(r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.strip_shared_lines(df.union(spark.createDataFrame(most, df.schema))).collect() if r["doc_id"] in (300, None)]
    assert sorted(more, key=str) == [(300, " mine\n  ", 50), (None, f"{footer}\n", 0), (None, "and some other words here", 1), (None, "one more", 0)]
    assert line_dedup.strip_shared_lines(df.limit(0)).count() == 0


def test_threshold_counts_sites_not_rows(spark):
    rows = [(k, "line of one site") for k in range(500)] + [(k, f"s{k}") for k in range(3)]
    lines = spark.createDataFrame([("a", f"s{k % 9}") for k in range(500)] + [("b", f"s{k}") for k in range(10)] + [("c", f"s{k}") for k in range(300)], "key string, site string")
    assert len(rows) and {r["key"]: r["n_sites"] for r in line_dedup.shared_lines(lines, 10).collect()}.keys() == {"b", "c"}


def rule_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = re.split("[?#]", rest[cut:])[0]
    found = [(len(r), v, r) for v, r in catalog.URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    _, verdict, rule = max(found, default=(0, None, None))
    return host, path, rule, verdict


def test_url_rules_and_model(spark):
    odd = [None, "", "no scheme", "http://", "http://COM/x", "http://a.COM", "http://a.com?x=/en/", "x://example.com/en/1", "x://www.example.com/en/1#a", "y://www.Example.com/en", "z://notexample.com/en/", "q://a.net/es/://b.com/", "é://É.net/fr/Ü"]
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(10_000 + k, u) for k, u in enumerate(odd)] + [(None, "http://x.org/")], "page_id long, url string")
    )
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    got = url_filter.judge(pages, catalog.URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = rule_by_hand(urls[r["id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    # By the models alone, most URLs that a rule decides get its verdict.
    ruled = [r for r in got if r["rule"]]
    cut = sorted(r["score"] for r in ruled)[sum(r["verdict"] == "allow" for r in ruled)]
    assert sum((r["score"] >= cut) == (r["verdict"] == "block") for r in ruled) >= 0.85 * len(ruled)


def test_models_tell_urls_they_have_not_counted(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    fold = F.pmod(F.xxhash64(F.expr("substring(url, instr(url, '://') + 3)")), F.lit(url_filter.CALIBRATION_FOLDS))
    uncounted = {r["page_id"] for r in pages.where(fold == 0).collect()}
    ruled = [r for r in url_filter.judge(pages, catalog.URL_RULES).collect() if r["rule"] and r["id"] in uncounted]
    cut = sorted(r["score"] for r in ruled)[sum(r["verdict"] == "allow" for r in ruled)]
    assert len(ruled) > 150
    assert sum((r["score"] >= cut) == (r["verdict"] == "block") for r in ruled) >= 0.95 * len(ruled)


@pytest.mark.parametrize("rows,size", [(4096, 1 << 19), (7, 200)])
def test_url_scores_equal_brute_force(spark, monkeypatch, rows, size):
    """Back-off over dictionaries of contexts; also with chunks so small that there are many."""
    monkeypatch.setattr(url_filter, "CHUNK_ROWS", rows)
    monkeypatch.setattr(url_filter, "CHUNK_BYTES", size)
    rng = random.Random(6)
    known = [("".join(rng.choices("ab/.é" if k % 3 else "abz-", k=rng.randrange(30))), k % 3 == 0) for k in range(200)]
    asked = [*(t for t, _ in known[:40]), "", None, "x" * 5000, "ünknown", "a.b/zz-", known[3][0], known[3][0]]
    seen = [{}, {}]
    for text, blocked in known:
        data = b"\x02" * 5 + text.encode()
        for at in range(5, len(data)):
            for k in range(6):
                for key in ((k, data[at - k : at]), (k, data[at - k : at], data[at])):
                    seen[blocked][key] = seen[blocked].get(key, 0) + 1

    def score(text):
        data, total = b"\x02" * 5 + (text or "").encode(), 0.0
        for at in range(5, len(data)):
            for side, sign in ((0, -1), (1, 1)):
                p = 1 / 256
                for k in range(6):
                    c = data[at - k : at]
                    p = (seen[side].get((k, c, data[at]), 0) + 4 * p) / (seen[side].get((k, c), 0) + 4)
                total += sign * np.log(p)
        return total / max(1, len(data) - 5)

    counts = url_filter.train(spark.createDataFrame(known, "text string, blocked boolean"))
    assert counts.count() == len({*seen[0], *seen[1]})
    got = url_filter.score(spark.createDataFrame(list(enumerate(asked)), "id int, text string"), counts).collect()
    assert len(got) == len(asked)
    for r in got:
        assert abs(r["score"] - score(asked[r["id"]])) < 1e-9


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(pages, catalog.URL_RULES).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), catalog.URL_RULES).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    plain, bad = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)], ["vile", "rotten", "nasty", "filthy"]
    rows = []
    for k in range(600):
        toxic = k % 6 == 0
        own = [rng.choice(plain) for _ in range(60)] + ([rng.choice(bad) for _ in range(rng.randrange(2, 6))] if toxic else [])
        if not toxic and k % 50 == 1:
            own.append("nasty")
        rng.shuffle(own)
        rows.append((k, " ".join(own), int(toxic)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (None, "vile rotten", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(901, 0, None), (None, 0, 1), (5, 0, 0), (10_000, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_toxicity_on_held_out_texts(spark, labelled):
    docs, labels = labelled
    index = toxicity.fit(docs, labels, F.col("doc_id") % 4 != 2)
    scored = toxicity.score(docs, index).collect()
    got = {r["id"]: r for r in scored}
    assert len(scored) == 603
    held_out = [k for k in range(600) if k % 4 == 2]
    assert sum(got[k]["predicted"] == (k % 6 == 0) for k in held_out) >= 0.97 * len(held_out)
    assert got[900]["score"] == got[901]["score"] < 0.3 and got[900]["evidence"] == [] and got[None]["predicted"] == 1
    assert all(got[k]["evidence"] for k in range(0, 600, 6))


def full_vectors(texts, index, idf_of):
    """TF-IDF vectors of texts over all their words, by dictionaries."""
    out = []
    for text in texts:
        counts = {}
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            counts[w] = counts.get(w, 0) + 1
        v = {w: (1 + np.log(n)) * idf_of(w) for w, n in counts.items()}
        length = sum(x * x for x in v.values()) ** 0.5
        out.append({w: x / length for w, x in v.items()})
    return out


@pytest.mark.parametrize("frequent", [0, 9, 512])
def test_nearest_examples_equal_brute_force(labelled, monkeypatch, frequent):
    """Over whole vectors of all words, with few blocks scored before bounds decide."""
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 1)
    docs, labels = labelled
    index = toxicity.fit(docs, labels, F.lit(True))
    by_id = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    n = 603
    words_of = {i: set(re.findall(r"[^\W\d_]+", (t or "").lower())) for i, t in by_id.items()}
    held = {w: sum(w in x for x in words_of.values()) + (w in ("vile", "rotten")) for w in index.terms}
    toxic = {int(i): y for i, y in zip(index.ids, index.toxic, strict=True)}

    def weight(w):
        if w not in index.terms:
            return (np.log((1 + n) / 2) + 1) * toxicity.PLAIN
        a = sum(w in words_of[i] for i, y in toxic.items() if y)
        b = sum(w in words_of[i] for i, y in toxic.items() if not y)
        m, pos = len(toxic), sum(toxic.values())
        c, d = pos - a, m - pos - b
        chi2 = m * (a * d - b * c) ** 2 / (pos * (m - pos) * (a + b) * (c + d) + 1e-9)
        return (np.log((1 + n) / (1 + held[w])) + 1) * (toxicity.PLAIN + (1 - toxicity.PLAIN) * chi2**2 / (chi2**2 + toxicity.HALF_CHI2**2))

    weights = {w: weight(w) for w in index.terms}
    idf_of = lambda w: weights.get(w) or weight(w)
    examples = full_vectors([by_id[int(i)] for i in index.ids], index, idf_of)
    rng = random.Random(0)
    asked = [" ".join(rng.choices([*index.terms, "unknown", "neither"], k=rng.randrange(1, 40))) for _ in range(40)]
    for text, v in zip(asked, full_vectors(asked, index, idf_of), strict=True):
        cosines = np.array([sum(x * e.get(w, 0) for w, x in v.items()) for e in examples])
        want = [k for k in np.lexsort((index.ids, -cosines.round(12)))[:7] if cosines[k] > 0]
        found, values = toxicity.nearest(index, *toxicity._vector(toxicity._counts(text), index), 7)
        assert np.allclose(values, cosines[want])
        assert sorted(index.ids[found][values > values[-1] + 1e-9]) == sorted(index.ids[want][cosines[want] > cosines[want][-1] + 1e-9])


def test_every_example_finds_itself(spark, labelled):
    """Also of a kind that only three toxic examples are of, whose copies are toxic."""
    docs, labels = labelled
    rng = random.Random(3)
    rare = [(700 + k, " ".join(["grumbleton", "snark", *(f"w{chr(97 + rng.randrange(26))}a" for _ in range(60))]), "x") for k in range(3)]
    docs = docs.union(spark.createDataFrame(rare + [(800 + k, t, "x") for k, (_, t, _) in enumerate(rare)], docs.schema))
    labels = labels.union(spark.createDataFrame([(700 + k, 0, 1) for k in range(3)], labels.schema))
    index = toxicity.fit(docs, labels, F.lit(True))
    scored = {r["id"]: r for r in toxicity.score(docs, index).collect()}
    for i in index.ids:
        assert scored[int(i)]["cosines"][0] == 1.0
    assert all(scored[k]["predicted"] == 1 for k in (*range(700, 703), *range(800, 803)))
    assert [scored[800 + k]["evidence"][0] for k in range(3)] == [700, 701, 702]


def test_toxicity_without_labels_or_rows(spark, labelled):
    docs, labels = labelled
    for some in (labels.limit(0), labels.where("toxic = 0")):
        index = toxicity.fit(docs, some, F.lit(True))
        assert {r["predicted"] for r in toxicity.score(docs, index).collect()} == {0}
    index = toxicity.fit(docs.limit(0), labels, F.lit(True))
    assert toxicity.score(docs.limit(0), index).count() == 0


ITEM = "On Monday Alice walked 12 km from Paris to the old mill and then another 5 km back to Paris, so how far did Alice walk in all that day?"


def test_leaks_with_other_values(spark):
    moved = ITEM.replace("Alice", "Bob Stone").replace("12", "340").replace("Paris", "Rome").replace("5 km", "7 miles")
    mixed = ITEM.replace("back to Paris", "back to Rome").replace("did Alice", "did Carol")
    prose = " ".join(f"filler{k}" for k in range(40))
    docs = [
        (1, f"{prose} {ITEM} {prose}"), (2, f"{prose}\n{moved}\n{prose}"), (3, prose), (4, None), (5, ""), (6, f"{prose} {mixed}"),
        (7, " ".join(ITEM.split()[:9]) + " " + prose), (8, f"{ITEM} {ITEM} {moved}"), (None, ITEM), (9, prose * 3000), (1, prose),
    ]
    df = spark.createDataFrame([(i, t, "h", 3, "t") for i, t in docs], "doc_id long, text string, h string, word int, template string")
    items = spark.createDataFrame([(50, ITEM), (51, ITEM), (52, None), (53, "too short"), (None, ITEM), (54, "a small item of six words")], "item_id long, text string")
    got = {(r["id"], r["item"]): r for r in decontamination.leaks(df, items).collect()}
    assert {k for k, _ in got} == {1, 2, 6, 8} and {k for _, k in got} == {50, 51}
    assert not got[1, 50]["changed"] and got[2, 51]["changed"] and not got[8, 50]["changed"]
    assert got[1, 50]["first_word"] == 40
    assert decontamination.leaks(df.limit(0), items).count() == 0
    assert decontamination.leaks(df, items.limit(0)).count() == 0


def test_leaks_of_items_with_few_words(spark):
    """Arithmetic, series, capitals and titles have too few literal words for a template, not for a copy."""
    items = [
        (60, "Compute 12 + 7 - 3 then 45 / 9 and 81 * 2 - 17 + 4 / 8 - 5 + 6"),
        (61, "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3"),
        (62, "WHICH OF THE FOLLOWING GASES MAKES UP MOST OF THE AIR THAT WE BREATHE TODAY?"),
        (63, "The Winter's Tale"),
        (64, "now add all of these numbers up as fast as you can please 7 8 9 10 11 12 13 14 15 16 17 18 19 20"),
        (65, "?!"),
    ]
    prose = " ".join(f"filler{k}" for k in range(40))
    docs = [(i, f"{prose} Hello {t.lower() if i == 62 else t} Bye {prose}") for i, t in items]
    docs += [(70, f"{prose} 7 8 9 10 11 12 13 14 15 16 17 18 19 20"), (71, items[0][1].replace("+", "*").replace("9 and", "8 and")), (72, prose), (73, "winter's tale the"), (74, "")]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["id"], r["item"]): r for r in found.collect()}
    assert set(got) == {(60, 60), (61, 61), (62, 62), (63, 63), (64, 64), (70, 64)}
    assert got[63, 63]["first_word"] == 41 and not any(r["changed"] for r in got.values())


def test_leaks_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = {(r["id"], r["item"], r["n_windows"]) for r in decontamination.leaks(docs, items).collect()}

    def tokens(text):
        out = []
        for word in text.split():
            kind, form = decontamination._kind(word)
            if kind == decontamination.NOTHING:
                continue
            if kind == decontamination.UNIT and (not out or out[-1][0] != decontamination.NUMBER):
                kind = decontamination.LITERAL
            if kind == decontamination.NAME and out and out[-1][0] == kind:
                out[-1] = (kind, out[-1][1] + " " + form)
            else:
                out.append((kind, form))
        return out

    def windows(text):
        t = tokens(text)
        for k in range(len(t) - 12):
            w = t[k : k + 13]
            if sum(kind == decontamination.LITERAL for kind, _ in w) >= 6.5:
                yield k, tuple((kind, form if kind == decontamination.LITERAL else "") for kind, form in w), [f for kind, f in w if kind != decontamination.LITERAL]

    known = {}
    for r in items.collect():
        for k, w, slots in windows(r["text"]):
            known.setdefault(w, []).append((r["item_id"], k, slots))
    aligned = {}
    for r in docs.collect():
        for k, w, slots in windows(r["text"]):
            for item, at, own in known.get(w, ()):
                if len(set(zip(own, slots, strict=True))) != len(set(own)):
                    continue
                starts, pairs = aligned.setdefault((r["doc_id"], item, k - at), (set(), set()))
                starts.add(k)
                pairs.update(zip(own, slots, strict=True))
    want = {}
    for (doc, item, _), (starts, pairs) in aligned.items():
        if not pairs or len(pairs) - len(dict(pairs)) < 0.5 * len(dict(pairs)):
            want.setdefault((doc, item), set()).update(starts)
    assert got == {(doc, item, len(starts)) for (doc, item), starts in want.items()}
    assert len(got) >= 20
