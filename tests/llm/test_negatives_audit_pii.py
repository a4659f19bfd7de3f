"""Hard negatives, source divergence and personal data against brute force, and their edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.llm import hard_negatives, pii, source_audit

VECTORS = "vec_id long, embedding array<float>, label int, id string, anchor int, region string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], VECTORS)


def clustered(seed, n, dims, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = [(k, (centres[k % 12] + 0.15 * rng.normal(size=dims)).tolist(), int(k % labels)) for k in range(n)]
    # Copies make ties: of an anchor, of a row beside it, and across labels.
    rows += [(n + k, rows[k][1], rows[k][2]) for k in range(40)]
    rows += [(n + 40 + k, rows[0][1], labels - 1) for k in range(30)]
    return rows


def mined(rows, every, k=5, m=3):
    """The negatives of every anchor, by comparing all rows."""
    whole = [(i, tuple(int(np.floor(np.float64(np.float32(x)) * 256)) for x in v), label) for i, v, label in rows]
    out = set()
    for i, v, label in whole:
        if i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, w, other in whole if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scores if x[2] == label)[:k]:
            near = sorted(x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:m]
            out |= {(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(near)}
    return out


def result(df):
    return Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


@pytest.mark.parametrize("block,group", [(1 << 14, 1 << 22), (64, 200)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, group):
    """Also with blocks and groups of anchors so small that there are many of both."""
    monkeypatch.setattr(hard_negatives, "BLOCK_NUMBERS", block)
    monkeypatch.setattr(hard_negatives, "GROUP_NUMBERS", group)
    rows = clustered(3, 700, 8) + [(5000, [0.5] * 3, 1), (5050, [0.4] * 3, 2), (5100, [0.45] * 3, 1)]
    got = result(hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert got == Counter(mined(rows, 50)) and got


def test_zone_maps_rule_blocks_out(spark, monkeypatch):
    """Blocks that bounds rule out are not needed, and regions without a needed block are not read."""
    monkeypatch.setattr(hard_negatives, "BLOCK_NUMBERS", 64)
    monkeypatch.setattr(hard_negatives, "REGION_NUMBERS", 2000)
    rng = np.random.default_rng(5)
    rows = [(k, (np.eye(12)[k % 12] * 3 + 0.05 * rng.normal(size=12)).tolist(), 0) for k in range(2400)]
    seen = []
    needed = hard_negatives._needed

    def watched(shared, n):
        seen.append(shared.value)
        return needed(shared, n)

    monkeypatch.setattr(hard_negatives, "_needed", watched)
    whole = frame(spark, rows).select(F.col("vec_id").alias("id"), F.col("label").cast("long"), (F.col("vec_id") == 24).alias("anchor"), F.col("embedding").cast("array<double>").alias("vec"))
    blocks = hard_negatives.blocks_of(whole.mapInArrow(hard_negatives._whole(256), "id long, label long, anchor boolean, vec array<int>, n int"))
    (group,) = hard_negatives._groups(blocks)
    group.ask(np.full((1, 1), hard_negatives.LEAST), np.full((1, 1), hard_negatives.MOST), 5, True)
    best = hard_negatives.search(blocks, group)
    assert {r["id"] % 12 for r in best.collect()} == {0} and best.count() == 5
    zones = blocks.select("block", "region", "label", "lo", "hi")
    read = zones.mapInArrow(needed(spark.sparkContext.broadcast(seen[0]), 12), "block long, region int, asked long")
    assert 0 < read.count() < blocks.count() / 4
    assert read.select("region").distinct().count() < blocks.select("region").distinct().count()
    assert "PartitionFilters: [region" in best._jdf.queryExecution().toString()


def test_neighbours_on_the_curve_are_one_step_apart():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = hard_negatives.hilbert(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.0], 2), (3, None, 2), (4, [0.8, None], 2), (5, [0.8, float("nan")], 2)]
    rows += [(6, [float("inf"), 0.0], 1), (7, [0.8, 0.0], None), (None, [0.8, 0.0], 2), (8, [0.8], 2), (9, [3e38, 0.0], 2), (50, [], 1), (51, [], 1), (52, [], 2)]
    # Of rows that share an id the least by label and numbers counts.
    rows += [(2, [0.9, 0.0], 2), (2, [0.9, 0.0], 3), (0, [1.0, 0.0], 1), (100, [-1.0, 0.0], 4), (101, [1.0, 0.0], 4)]
    got = result(hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert got == Counter([(0, 1, 1, 2, 256 * 230, 256 * 179), (50, 51, 1, 52, 0, 0)])
    empty = hard_negatives.mine(frame(spark, []), F.col("vec_id") % 50 == 0)
    assert empty.collect() == [] and empty.columns == [c.split()[0] for c in hard_negatives.MINED.split(", ")]
    assert hard_negatives.mine(frame(spark, rows), F.col("vec_id") < 0).count() == 0


def test_large_numbers_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, [float(np.float32(rng.uniform(-100_000, 100_000))) for _ in range(4)], k % 3) for k in range(120)]
    assert result(hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 50 == 0)) == Counter(mined(rows, 50))


DOCS = "doc_id long, text string, lang string, source string, term string, N int"


def audited(rows, min_docs, top):
    docs = [(lang or "", source or "", [w for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(w for d in mine for w in set(d[2]))
        kept = [w for w in held if held[w] >= min_docs]
        counts = {s: Counter(w for d in mine if d[1] == s for w in d[2] if held[w] >= min_docs) for s in {d[1] for d in mine}}
        counts[None] = Counter(w for d in mine for w in d[2] if held[w] >= min_docs)
        p = {s: {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept} for s, c in counts.items()}
        f = lambda a, b, w: (p[a][w] - p[b][w]) ** 2 // (p[a][w] + p[b][w])
        for a in counts:
            if a is None:
                continue
            pairs = sorted((-sum(f(a, b, w) for w in kept), b.encode(), b) for b in counts if b not in (None, a))
            terms = sorted((-f(a, None, w), w.encode(), w) for w in kept if counts[a][w] and p[a][w] > p[None][w])[:top]
            out |= {(lang, a, kind, item, -v, k + 1) for kind, some in (("pair", pairs), ("term", terms)) for k, (v, _, item) in enumerate(some)}
    return out


def spread_docs(seed, n, sources):
    rng = random.Random(seed)
    common = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}é" for k in range(60)]
    rows = []
    for k in range(n):
        source = f"s{rng.randrange(sources)}" if rng.random() < 0.6 else "hot"
        own = [f"only{source}"] * rng.randrange(3)
        rows.append((" ".join(rng.choices(common, k=rng.randrange(12)) + own), rng.choice(["en", "de"]), source))
    return rows


@pytest.mark.parametrize("block,strip,kept", [(32, 1024, 200_000), (4, 8, 10)])
def test_divergence_equals_brute_force(spark, monkeypatch, block, strip, kept):
    """Also with several row blocks and strips, and counts passed on early."""
    for name, value in (("BLOCK", block), ("STRIP", strip), ("TERMS_KEPT", kept)):
        monkeypatch.setattr(source_audit, name, value)
    rows = spread_docs(1, 400, 11)
    rows += [(None, "en", "s1"), ("", "en", "empty"), ("Two two\ttwo! TWO", None, None), ("日本語 x_y 1a2b É é", "de", "hot")] + [("Ünique Word", "xx", "alone")] * 9
    rows += [("few words", "yy", s) for s in "abc"] + [("tie tie", "zz", s) for s in "abcdefgh"] * 2
    df = spark.createDataFrame([(k // 2, *r, "t", 1) for k, r in enumerate(rows)], DOCS)
    made = source_audit.audit(df, min_docs=4)
    got = [("pair", *r) for r in made.pairs.collect()] + [("term", *r) for r in made.terms.collect()]
    assert Counter((lang, source, part, item, value, rank) for part, lang, source, item, value, rank in got) == Counter(audited(rows, 4, 10))


def test_empty_quadrants_are_priced_without_descent():
    rows, columns = np.array([0, 1, 1]), np.array([0, 0, 1])
    tree = source_audit.Quadtree(rows, columns, np.array([3, 1, 2]), 10)
    m = np.array([3 + 2000, 3 + 2000, 2000])
    sums, pruned = source_audit.compare(tree, range(3), range(3), m, 1000)
    p = {(r, c): 1 + 10**9 * (n + 2) // m[r] for r in range(3) for c in range(1000) for n in [{(0, 0): 3, (1, 0): 1, (1, 1): 2}.get((r, c), 0)]}
    for a, b in ((0, 1), (0, 2), (1, 2)):
        assert sums[a, b] == sum((p[a, c] - p[b, c]) ** 2 // (p[a, c] + p[b, c]) for c in range(1000))
    assert 0 < pruned < 60


def test_divergence_of_nothing(spark):
    for rows in ([], [(1, None, None, None, None, None)], [(1, "a", "en", "x", None, None), (2, "b", "en", "y", None, None)]):
        made = source_audit.audit(spark.createDataFrame(rows, DOCS))
        assert [r["value"] for r in made.pairs.collect()] == ([0, 0] if len(rows) == 2 else []) and made.terms.count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def proposed(text):
    """The base spans by the patterns as they stand."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            odd, even = digits[::-1][::2], digits[::-1][1::2]
            total = sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)
            fine = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits, t=total: 16 <= len(d) <= 19 and t % 10 == 0,
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if fine:
                out.append((kind, *m.span()))
    return out


PARTS = st.sampled_from(
    ["a.b", "@", "x@y.z", ".", "1", "255", "256", "1.2.3.4", "4242424242424242", "4242 4242-4242 4242", " ", "-", "+", "+1 (482) 555-7163", "(", ")", "é", "\n", "00", "日", "_", "%", "9" * 17]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14))
def test_base_spans_equal_the_plain_patterns(parts):
    text = "".join(parts)
    assert [s[:3] for s in pii.spans_of(text) if s.base] == proposed(text)


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 here", ["iban"]),
        ("IBAN DE89 3704 0044 0532 0130 01 here", []),
        ("ref GB82WEST12345698765432, ok", ["iban"]),
        ("my ssn is 123-45-6789", ["ssn"]),
        ("order 123-45-6789", []),
        ("call (212) 555-0123 now", ["local_phone"]),
        ("serial (212) 555-0123", []),
        ("visa 2024 4242424242424242", ["plain_card"]),
        ("2024 4242424242424242", []),
        ("4242 4242 4242 4242", ["card"]),
        ("4242 4242 4242 4241", []),
    ],
)
def test_checks_and_words_nearby_decide(text, kinds):
    assert [s.kind for s in pii.spans_of(text)] == kinds


def test_words_nearby_move_the_score():
    plain, named, other = (pii.spans_of(t)[0].score for t in ("x 1.2.3.4", "host 1.2.3.4", "version 1.2.3.4"))
    assert other < plain < named


def test_pii_of_odd_rows(spark):
    long = "word " * 300_000 + "me@x.org " + "1" * 100_000
    rows = [(1, None, 5, "k"), (1, "", 5, "k"), (None, "a@b.c", 5, "k"), (2, long, 5, "k"), (2, "é a@b.c 🙂 +12345678", 5, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, PII int, kind string")
    got = pii.find(df, mask_into="masked").orderBy("doc_id", F.length("text")).collect()
    assert [[(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in got] == [
        [("email", 0, 5)], [], [], [("email", 2, 7), ("phone", 10, 19)], [("email", 1_500_000, 1_500_008)]
    ]
    assert [r["masked"] for r in got[:4]] == ["<email>", None, "", "é <email> 🙂 <phone>"]
    assert got[0]["kind"] == "k" and pii.find(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["a" * 10**6, "1" * 10**6, "1 " * 10**6, "@a.b" * 10**5, "+1(" * 10**5, "1." * 10**5, "a@" * 10**5])
def test_patterns_take_linear_time(text):
    pii.spans_of(text)
