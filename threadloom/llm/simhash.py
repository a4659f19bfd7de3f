"""SimHash fingerprints and their links, found by a grid over segment popcounts.

A fingerprint's 64 bits form 32 segments of two bits; the bit counts of the segments are
a point in 32 dimensions, and the Manhattan distance of two points never exceeds the
Hamming distance of the fingerprints. The points are split into two blocks of 16
dimensions. If two fingerprints differ in at most three bits, their points are at most
one apart in one of the blocks: they share that block's grid cell, or one lies one step
below the other in one dimension. So every fingerprint goes to its own cell of each block
and to the cells one step below, and whatever meets in a cell is compared bit by bit.

Rows with equal fingerprints are one node. Cells with very many fingerprints are dealt to
pairs of chunks, so no task holds more than two chunks; each task returns a shortest
spanning forest of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import components, mix, steps, stored, texts_of, unite

BLOCK_BITS = 32
BLOCK_MASK = (1 << BLOCK_BITS) - 1
#: Two blocks: up to 2 * 2 - 1 = 3 differing bits leave one block with at most one.
MAX_BITS = 3
#: Most fingerprints of one cell that one chunk takes; a task compares two chunks.
CHUNK = 2048
#: Most rows of one cell whose shingle sets one chunk takes.
SETS = 512
SHORT_RUN = 48
LANES = np.uint64(0x0101010101010101)


def _shingle_hashes(text: bytes, words: int) -> list[int]:
    parts = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(b" ".join(parts), 42)] if parts else []
    joined = b" ".join(parts)
    starts = list(accumulate((len(p) + 1 for p in parts), initial=0))
    return [digest(joined[a : b - 1], 42) for a, b in zip(starts, starts[words:], strict=False)]


def _shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(np.array(_shingle_hashes(text, words), dtype=np.uint64))


def _majority(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per run of counts hashes: bit set where over half of them have it."""
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    if len(flat):
        ends = np.cumsum(counts)
        # Byte lanes hold sums of at most 255 hashes, so longer lists go in pieces.
        pieces = np.concatenate([np.arange(e - c, e, 255) for c, e in zip(counts, ends, strict=True)])
        owner = np.searchsorted(ends, pieces, side="right")
        for k in range(8):
            sums = np.add.reduceat((flat >> np.uint64(k)) & LANES, pieces.astype(np.int64))
            lanes = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
            per = np.zeros((len(counts), 8), dtype=np.int64)
            np.add.at(per, owner, lanes)
            ones[:, k::8] = per
    bits = (ones * 2 > counts[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(
    docs: DataFrame, words: int, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False
) -> DataFrame:
    """Rows (id, fp0, fp1, ...): SimHashes of the lower-cased (A-Z) shingles of every whole text.

    Each is a 64-bit fingerprint as a signed long, the first from the XXH64 (seed 42) of the
    shingles, further ones from hashes derived from it. A text with fewer words than a shingle
    is one shingle; null, empty and blank texts have fingerprint zero. Ids may be null or repeat.
    With distinct, every shingle of a text counts once, so none that repeats outvotes the others,
    and columns set0 and set1 are a 128-bit hash of the text's set of shingles.
    """
    names = [f"fp{k}" for k in range(lanes)] + (["set0", "set1"] if distinct else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            hashes = [(_shingle_set if distinct else _shingle_hashes)(x, words) for x in texts_of(batch, "text")]
            counts = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
            flat = np.fromiter((h for some in hashes for h in some), dtype=np.uint64, count=int(counts.sum()))
            prints = [_majority(flat if k == 0 else mix(flat + np.uint64(k)), counts) for k in range(lanes)]
            if distinct:
                marks = b"".join(xxhash.xxh3_128_digest(h.tobytes()) for h in hashes)
                prints.extend(np.frombuffer(marks, dtype=np.int64).reshape(-1, 2).T)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, prints)], names=["id", *names])

    cut = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return cut.mapInArrow(run, ", ".join(["id long", *(f"{n} long" for n in names)]))


def _cells(nodes: DataFrame, *more: str) -> DataFrame:
    """Rows (cell, fp, more): the own cell of both blocks and the cells one step below it."""
    part = lambda shift: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(BLOCK_MASK))
    rows = None
    for block in range(2):
        bits = part(block * BLOCK_BITS)
        # The counts of all two-bit segments at once.
        counts = bits - F.shiftright(bits, 1).bitwiseAND(F.lit(0x55555555))
        below = F.expr(
            "transform(filter(sequence(0, 30, 2), s -> (shiftright(point, s) & 3) > 0), s -> point - shiftleft(1L, s))"
        )
        one = nodes.select("fp", *more, counts.alias("point")).select(
            "fp",
            *more,
            F.explode(F.concat(F.array("point"), below)).alias("cell"),
        )
        one = one.select((F.col("cell") + F.lit(block << BLOCK_BITS)).alias("cell"), "fp", *more)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _shortest(n: int, i: np.ndarray, j: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a shortest spanning forest, nearest pairs first."""
    labels, out = np.arange(n), [(i[:0], j[:0])]
    for level in np.unique(bits):
        a, b = i[bits == level], j[bits == level]
        while True:
            x, y = labels[a], labels[b]
            apart = x != y
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            # One pair for every class that joins a smaller one, so none closes a circle.
            _, first = np.unique(np.maximum(x, y)[apart], return_index=True)
            out.append((a[first], b[first]))
            labels = unite(labels, a[first], b[first])
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _forest(fps: np.ndarray, runs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a shortest spanning forest within every run of equal run numbers."""
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.r_[starts, len(fps)])
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    pairs, edges = [], []
    for step in range(1, min(SHORT_RUN, int(sizes.max(initial=0)))):
        i = np.flatnonzero(short[:-step] & (runs[:-step] == runs[step:]))
        bits = np.bitwise_count(fps[i] ^ fps[i + step])
        near = bits <= max_bits
        pairs.append((i[near], i[near] + step, bits[near]))
    if pairs:
        edges.append(_shortest(len(fps), *(np.concatenate(c) for c in zip(*pairs, strict=True))))
    for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        own, pairs = fps[start : start + size], []
        for row in range(0, size, 256):
            bits = np.bitwise_count(own[row : row + 256, None] ^ own[None, :])
            i, j = np.nonzero(bits <= max_bits)
            later = j > i + row
            i, j = i[later], j[later]
            pairs.append(((i + row).astype(np.int32), j.astype(np.int32), bits[i, j]))
        a, b = _shortest(size, *(np.concatenate(c) for c in zip(*pairs, strict=True)))
        edges.append((start + a, start + b))
    if not edges:
        return fps[:0], fps[:0]
    return fps[np.concatenate([a for a, _ in edges])], fps[np.concatenate([b for _, b in edges])]


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, dtype=np.int64)] * 4

        def out(columns) -> pa.RecordBatch:
            keys, fps = columns[:3], columns[3]
            changes = np.zeros(len(fps), dtype=np.int64)
            for key in keys:
                changes[1:] |= key[1:] != key[:-1]
            a, b = _forest(fps.view(np.uint64), np.cumsum(changes), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            columns = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns, strict=True)]
            # The last run may go on in the next batch.
            same = np.logical_and.reduce([c == c[-1] for c in columns[:3]])
            cut = len(same) if not len(same) else len(same) - (np.argmin(same[::-1]) if not same.all() else len(same))
            rest = [c[cut:] for c in columns]
            if cut:
                yield out([c[:cut] for c in columns])
        if len(rest[0]):
            yield out(rest)

    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Rows (a, b) of fingerprints that differ in at most max_bits bits.

    nodes has distinct fingerprints (fp). The rows form a spanning forest per cell, so their
    connected components are those of all such pairs if max_bits is 3 or less. With a higher
    max_bits, pairs of more than 3 differing bits are found only if their points are at most one
    apart in one of the blocks.
    """
    rows = _cells(nodes)
    crowded = stored(rows.groupBy("cell").count().where(F.col("count") > chunk), "cells")
    share = F.coalesce(F.ceil(F.col("count") / chunk), F.lit(1)).cast("int")
    dealt = (
        rows.join(crowded, "cell", "left")
        .select("cell", "fp", share.alias("k"))
        .select("cell", "fp", "k", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int").alias("own"))
        .select("cell", "fp", "own", F.explode(F.expr("sequence(0, k - 1)")).alias("other"))
        .select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    )
    return (
        dealt.repartition("cell", "x", "y")
        .sortWithinPartitions("cell", "x", "y", "fp")
        .mapInArrow(_links(max_bits), "a long, b long")
    )


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """Rows (fp, component) of all fingerprints of prints (id, fp)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"two blocks find all pairs of up to {MAX_BITS} differing bits")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(nodes.select("fp"), max_bits))
    classes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = classes.groupBy("root").agg(F.min("first").alias("component"))
    return stored(classes.join(least, "root").select("fp", "component"), "classes")


def near_groups(
    docs: DataFrame, words: int = 5, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, fp, component): one per row of docs, with the smallest id reachable by links.

    Rows with equal fingerprints link, fingerprint zero (no words) among them. A null id never
    names a component unless all ids of the component are null.
    """
    prints = stored(fingerprints(docs, words, 1, id_col, text_col).withColumnRenamed("fp0", "fp"), "fingerprints")
    return prints.join(_classes(prints, max_bits), "fp").select("id", "fp", "component")


def repeats(docs: DataFrame, words: int = 5, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id): the documents to drop so that one of each group of near_groups stays, the smallest id.

    Rows that share an id are one document: it goes only if each of its rows is in a group of a smaller
    id. Rows with a null id are never dropped.
    """
    groups = near_groups(docs, words, max_bits, id_col, text_col).where("id is not null")
    return groups.groupBy("id").agg(F.bool_and(F.col("id") != F.col("component")).alias("gone")).where("gone").select("id")


def hex_of(fp):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _lane_links(nodes: DataFrame, name: str, max_bits: int) -> DataFrame:
    """Rows (a, b) of nodes linked in one of their fingerprints, each known by the smallest node that has it."""
    known = nodes.groupBy(F.col(name).alias("fp")).agg(F.min("node").alias("first"))
    found = links(known.select("fp"), max_bits)
    first = known.select(F.col("fp").alias("a"), F.col("first").alias("x"))
    second = known.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    far = found.join(first, "a").join(second, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    equal = nodes.join(known, nodes[name] == known["fp"]).select(F.col("node").alias("a"), F.col("first").alias("b"))
    return stored(far.unionByName(equal.where("a <> b")), "links")


def _similar(words: int, min_similarity: float):
    """Arrow function that keeps the pairs (a, b) whose texts' shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shingles = None, frozenset()
        for batch in batches:
            keep = []
            for mine, other in zip(texts_of(batch, "text_a"), texts_of(batch, "text_b"), strict=True):
                if other != last:
                    last, shingles = other, frozenset(_shingle_hashes(other, words))
                own = frozenset(_shingle_hashes(mine, words))
                both = len(own & shingles)
                keep.append(both >= min_similarity * (len(own) + len(shingles) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(words: int):
    """Arrow function from (node, text) to the sorted distinct shingle hashes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = [_shingle_set(x, words).tobytes() for x in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _open_pairs(table: pa.Table, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one cell that are near and of different roots, and their differing bits.

    Pairs within a chunk are taken where only that chunk is, and pairs of equal points, which
    meet in many cells, in their own cell.
    """
    of = lambda name: table.column(name).to_numpy()
    fps, roots, own, cell = of("fp").view(np.uint64), of("root"), of("own"), int(table.column("cell")[0].as_py())
    within = table.column("x")[0].as_py() == table.column("y")[0].as_py()
    half = (fps >> np.uint64(BLOCK_BITS * (cell >> BLOCK_BITS & 1))) & np.uint64(BLOCK_MASK)
    points = half - ((half >> np.uint64(1)) & np.uint64(0x55555555))
    below = points != np.uint64(cell & BLOCK_MASK)
    found = []
    for row in range(0, len(fps), 256):
        part = slice(row, row + 256)
        bits = np.bitwise_count(fps[part, None] ^ fps[None, :])
        near = (bits <= max_bits) & (roots[part, None] != roots[None, :])
        near &= ~(below[part, None] & (points[part, None] == points[None, :]))
        if not within:
            near &= own[part, None] != own[None, :]
        i, j = np.nonzero(near)
        later = j > i + row
        i, j = i[later], j[later]
        found.append((i + row, j, bits[i, j]))
    i, j, bits = (np.concatenate(c) for c in zip(*found, strict=True))
    return i, j, bits


def _involved(max_bits: int):
    def run(table: pa.Table) -> pa.Table:
        i, j, _ = _open_pairs(table, max_bits)
        return table.take(pa.array(np.unique(np.r_[i, j])))

    return run


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles any two sets have in common, by blocks of the shingles that several have."""
    sizes = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[code] > 1
    owner, code = owner[several], (np.cumsum(counts > 1) - 1)[code[several]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(sets), len(sets)))
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, b = np.searchsorted(code, [start, start + 4096])
        has = np.zeros((len(sets), 4096), dtype=np.float32)
        has[owner[a:b], code[a:b] - start] = 1
        both += has @ has.T
    return both


def _joined(max_bits: int, min_similarity: float):
    """Function of one cell's rows with shingle sets: a spanning forest of its similar enough pairs, as roots."""

    def run(table: pa.Table) -> pa.Table:
        i, j, bits = _open_pairs(table, max_bits)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        both = _shared(sets)[i, j].astype(np.int64)
        alike = both >= min_similarity * (sizes[i] + sizes[j] - both)
        a, b = _shortest(len(sets), i[alike], j[alike], bits[alike])
        roots = table.column("root")
        return pa.table({"a": roots.take(pa.array(a)), "b": roots.take(pa.array(b))})

    return run


def _passed_over(classes: DataFrame, texts: DataFrame, names: list[str], words: int, max_bits: int, min_similarity: float) -> DataFrame:
    """Rows (a, b) of roots joined by a similar pair of their nodes that was in no forest.

    classes has (node, root) and the fingerprints of nodes, texts their (id, text). In every cell
    all near pairs of different roots are found, and the shingle sets of the nodes in them are sent
    there and compared; rows stay linear in nodes and cells, pairs never leave a task.
    """
    rows = None
    for k, name in enumerate(names):
        one = _cells(classes.select(F.col(name).alias("fp"), "node", "root"), "node", "root")
        one = one.withColumn("cell", F.col("cell") + F.lit(k << (BLOCK_BITS + 1)))
        rows = one if rows is None else rows.unionByName(one)
    rows = stored(rows, "cells")

    def dealt(rows: DataFrame, chunk: int) -> DataFrame:
        cells = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s"))
        cells = cells.where("r < s").select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("k"))
        return (
            rows.join(cells, "cell")
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
            .select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "root", "fp")
        )

    schema = "cell long, x int, y int, own int, node long, root long, fp long"
    found = dealt(rows, CHUNK).groupBy("cell", "x", "y").applyInArrow(_involved(max_bits), schema)
    found = stored(found.select("cell", "node", "root", "fp").distinct(), "involved")
    sets = texts.select(F.col("id").alias("node"), "text").join(found.select("node").distinct(), "node", "left_semi")
    sets = stored(sets.mapInArrow(_sets(words), "node long, shingles binary"), "sets")
    met = dealt(found, SETS).join(sets, "node").groupBy("cell", "x", "y")
    return met.applyInArrow(_joined(max_bits, min_similarity), "a long, b long").distinct()


def near_copies(
    docs: DataFrame,
    words: int = 5,
    lanes: int = 4,
    max_bits: int = 9,
    min_similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, of): documents in a group of near copies whose smallest id is another, the one that stays.

    Two documents link if in one of several independent fingerprints (lanes) they differ in at most
    three bits, or in at most max_bits and lie within a step in one block, and their shingle sets have a Jaccard similarity of min_similarity or
    more, which is computed exactly; one fingerprint misses many near copies of short texts, and
    each further one is another chance. Fingerprints are of the distinct shingles, and documents of
    equal shingle sets are one node; equal fingerprints are a link like others. First the links of
    a shortest spanning forest per grid cell are compared; where some fail, so that what they joined
    falls apart, all other near pairs between the parts are compared, too. Rows that share an id are
    one document, of which some one text is compared; rows with a null id are never copies.
    """
    names = [f"fp{k}" for k in range(lanes)]
    rows = docs.where(F.col(id_col).isNotNull())
    prints = stored(fingerprints(rows, words, lanes, id_col, text_col, distinct=True), "fingerprints")
    nodes = stored(prints.groupBy("set0", "set1", *names).agg(F.min("id").alias("node")), "nodes")
    edges = _lane_links(nodes, names[0], max_bits)
    for name in names[1:]:
        edges = edges.unionByName(_lane_links(nodes, name, max_bits))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    linked = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    texts = rows.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = stored(texts.join(linked, "id", "left_semi").dropDuplicates(["id"]), "texts")
    pairs = edges.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    alike = pairs.select("a", "b", "text_a", "text_b").mapInArrow(_similar(words, min_similarity), "a long, b long")
    classes = nodes.join(components(alike), "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = stored(classes, "classes")
    # Near pairs that no forest has are within a root, or both their roots have a failed link to another.
    root_of = classes.select("node", "root").distinct()
    ends = edges.join(root_of.toDF("a", "x"), "a").join(root_of.toDF("b", "y"), "b").where("x <> y")
    apart = stored(ends.select(F.explode(F.array("x", "y")).alias("root")).distinct(), "apart")
    if not apart.isEmpty():
        parts = classes.join(apart, "root", "left_semi")
        more = components(_passed_over(parts, texts, names, words, max_bits, min_similarity))
        classes = classes.join(more.toDF("root", "least"), "root", "left").withColumn("root", F.coalesce("least", "root"))
    named = stored(classes.select("set0", "set1", F.col("root").alias("of")), "named")
    return prints.join(named, ["set0", "set1"]).where("id <> of").select("id", "of").distinct()
