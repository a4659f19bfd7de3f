"""SimHash, substring and embedding near-dedup against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash

from threadloom.llm import embedding_graph, simhash, substring

DOCS = "doc_id long, text string, id string, FP int, tag int, component string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One two"), (5, "one  TWO"), (6, "Élan vital ÀB"), (7, "élan vital àb")]
    for k in range(12):
        base = words(rng, rng.randrange(5, 400))
        out.append((10 + 10 * k, " ".join(base)))
        for j in range(1, 6):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = "changed"
            out.append((10 + 10 * k + j, "\n".join(own)))
    passage = words(rng, 60)
    for k in range(8):
        out.append((300 + k, " ".join(words(rng, 30 + k) + passage + words(rng, 20))))
    out.append((400, " ".join(["again"] * 50)))
    out.append((401, " ".join(words(rng, 30_000, 40))))
    out += [(350, out[-3][1]), (350, out[-3][1]), (351, " ".join(passage[:12])), (352, " ".join(passage[:13]))]
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], DOCS)


def fingerprint(text, n):
    parts = (text or "").encode().lower().split()
    grams = [b" ".join(parts[k : k + n]) for k in range(len(parts) - n + 1)] or ([b" ".join(parts)] if parts else [])
    bits = [sum(xxhash.xxh64_intdigest(g, seed=42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(grams))


def classes(keys, linked):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_simhash_groups_equal_brute_force(spark, texts):
    got = {(r["id"], r["hex"], r["component"]) for r in simhash.near_groups(frame(spark, texts), 3).withColumn("hex", simhash.hex_of("fp")).collect()}
    prints = {i: fingerprint(t, 3) for i, t in texts}
    near = [(i, j) for i in prints for j in prints if i < j and bin(prints[i] ^ prints[j]).count("1") <= 3]
    roots = classes(prints, near)
    assert got == {(i, f"{prints[i]:016x}", roots[i]) for i in prints}


def test_crowded_cells_lose_no_link(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (400, 4)).astype(np.uint64)).tolist()
    prints = sorted({int(centre) ^ a ^ b ^ c ^ d for a, b, c, d in flips} | set(rng.integers(0, 2**63, 300).tolist()))
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    linked = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(nodes, chunk=16).collect()]
    near = [(a, b) for k, a in enumerate(prints) for b in prints[:k] if bin(a ^ b).count("1") <= 3]
    assert classes(prints, linked) == classes(prints, near)


def test_near_copies_are_verified_by_shingles(spark):
    base = " ".join(words(random.Random(8), 300))
    rows = [(9, base), (4, base + " end"), (12, base), (7, "short"), (8, "short"), (30, None), (31, ""), (None, base)]
    got = {(r["id"], r["of"]) for r in simhash.near_copies(frame(spark, rows)).collect()}
    assert got == {(9, 4), (12, 4), (8, 7), (31, 30)}


def test_a_repeated_passage_makes_no_copies(spark):
    """Equal fingerprints are no proof: these texts share one passage and nothing else."""
    rng = random.Random(11)
    passage = words(rng, 5) * 100
    rows = [(k, " ".join(passage + words(rng, 40, 10**6))) for k in range(20)]
    rows += [(100 + k, " ".join(passage * (k + 1))) for k in range(2)]
    got = {(r["id"], r["of"]) for r in simhash.near_copies(frame(spark, rows)).collect()}
    assert got == {(101, 100)}


@pytest.mark.parametrize("chunk", [2048, 300])
def test_near_copies_hang_on_no_failed_link(spark, monkeypatch, chunk):
    """Documents of one template, each with a copy: every pair that is near and similar ends in one group."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "SETS", chunk)
    rng = random.Random(7)
    template, rows = words(rng, 300), []
    for k in range(400):
        own = list(template)
        for at in rng.sample(range(300), 8):
            own[at] = f"own{rng.randrange(10**6)}"
        rows.append((2 * k, " ".join(own)))
        for at in rng.sample(range(300), 6):
            own[at] = f"own{rng.randrange(10**6)}"
        rows.append((2 * k + 1, " ".join(own)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(296)} for i, t in rows}
    made = simhash.fingerprints(frame(spark, rows), 5, 4, distinct=True).collect()
    prints = {r["id"]: [r[f"fp{k}"] % 2**64 for k in range(4)] for r in made}

    def near(a, b):
        """Bits are few in a lane, and the points of a block at most one apart."""
        for x, y in zip(prints[a], prints[b], strict=True):
            if (x ^ y).bit_count() <= 9:
                for block in (0, 32):
                    steps = [(x >> s & 3).bit_count() - (y >> s & 3).bit_count() for s in range(block, block + 32, 2)]
                    if sum(map(abs, steps)) <= 1 or sorted(s for s in steps if s) == [-1, 1]:
                        return True
        return False

    alike = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and near(i, j)]
    roots = classes(list(sets), alike)
    got = {(r["id"], r["of"]) for r in simhash.near_copies(frame(spark, rows)).collect()}
    assert len(alike) > 50
    assert got == {(i, roots[i]) for i in roots if i != roots[i]}


def test_null_ids_and_empty_tables(spark):
    rows = simhash.near_groups(frame(spark, [(None, "a b c d"), (5, "a b c d"), (None, "z")]), 3).collect()
    assert sorted((r["id"] or -1, r["component"]) for r in rows if r["component"]) == [(-1, 5), (5, 5)]
    assert simhash.near_groups(frame(spark, []), 3).count() == 0
    assert simhash.near_copies(frame(spark, [])).count() == 0
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def kept(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("slot_bits", [10, 20])
def test_substring_removal_equals_brute_force(spark, texts, slot_bits):
    """A sketch far too small lets every window through; the result is the same."""
    rows = [*texts, (None, texts[3][1]), (360, "a " + (texts[5][1] or "")), (360, "b")]
    got = substring.remove_repeats(frame(spark, rows), slot_bits=slot_bits).collect()
    assert sorted((-1 if r["id"] is None else r["id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == kept(rows)


def vectors(rng):
    rows = []
    for label in (0, 1, 2):
        for _ in range(60):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 6)):
                rows.append((len(rows), (base + 0.12 * rng.normal(size=16)).astype(np.float32).tolist(), label))
    hub = rng.normal(size=16)
    for _ in range(300):
        rows.append((len(rows), (hub + 0.08 * rng.normal(size=16)).astype(np.float32).tolist(), 1))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(4)]
    rows.append((len(rows), [2 * x for x in rows[5][1]], rows[5][2]))
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, []]
    rows += [(len(rows) + k, v, 1) for k, v in enumerate(odd)]
    rows += [(len(rows), rows[5][1], None), (len(rows) + 1, [1.0, 2.0], 1), (len(rows) + 2, [1.0, 2.0], 1)]
    return rows


@pytest.mark.parametrize("shard,chunk", [(1500, 2500), (80, 60)])
def test_embedding_links_equal_brute_force(spark, monkeypatch, shard, chunk):
    """Once in single shards, once in many overlapping shards with crowded ones dealt to chunk pairs."""
    monkeypatch.setattr(embedding_graph, "SHARD", shard)
    monkeypatch.setattr(embedding_graph, "CHUNK", chunk)
    rows = vectors(np.random.default_rng(2))
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<float>, label int, node int, V string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_graph.near_vectors(df).collect()}
    fine = {
        i: (np.array(v, dtype=np.float32).astype(float), label)
        for i, v, label in rows
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    linked = [
        (i, j)
        for i, (a, la) in fine.items()
        for j, (b, lb) in fine.items()
        if i < j and la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93
    ]
    roots = classes([i for i, _, _ in rows], linked)
    degree = dict.fromkeys(roots, 0)
    for i, j in linked:
        degree[i] += 1
        degree[j] += 1
    total, found = sum(degree.values()), sum(n for n, _, _ in got.values())
    assert 0.99 * total <= found <= total
    assert all(n <= degree[i] for i, (n, _, _) in got.items())
    assert sum(got[i][1] != roots[i] for i in roots) <= 0.01 * len(roots)
    assert all(got[i][2] == (got[i][1] == i) for i in roots)


def test_where_no_graph_is_good_enough_all_pairs_are_compared(spark, monkeypatch):
    """Exactly the links of brute force, over several chunks of a label."""
    monkeypatch.setattr(embedding_graph, "MIN_RECALL", 1.1)
    monkeypatch.setattr(embedding_graph, "CHUNK", 16)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(9, 10))
    rows = [(k, (centres[k % 9] + 0.12 * rng.normal(size=10)).tolist(), k % 2) for k in range(240)] + [(300 + k, [1.0] * 10, 0) for k in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = np.array([np.array(v, dtype=np.float32) for _, v, _ in rows], dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93]
    roots = classes([r[0] for r in rows], near)
    counts = {r[0]: sum(r[0] in pair for pair in near) for r in rows}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_graph.near_vectors(df).collect()}
    assert got == {k: (counts[k], roots[k]) for k in counts} and len(near) > 200


def test_embedding_edge_cases(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_graph.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [0.0, 1.0], 1), (5, [0.0, 1.0], 1)]
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in embedding_graph.near_vectors(spark.createDataFrame(rows, schema)).collect())
    # Of the two vectors of id 3 the smaller one speaks for it.
    assert got == [(-1, 0, None, True), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 3, False)] or got == [
        (-1, 0, None, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (5, 2, 3, False)
    ]
