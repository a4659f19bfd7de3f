"""Vectors linked by cosine, found by search in a robust-pruned graph built in shards.

Equal vectors of a label are one node. Centres fitted on a bounded sample cut the nodes into
overlapping shards: each node joins the shards of its nearest centres, the nearest being its
home. A shard that is larger than a task should hold is dealt to pairs of chunks. Each task
builds a robust-pruned graph of its nodes; the adjacency lists of a node from all its shards
are united. Each home shard is then searched: greedily from its medoid, then outward through
all nodes in range. Found pairs are verified in double precision. Links of nodes that share a
home are counted in the task; only those across homes leave it as pairs. Recall is audited
against brute force for a fixed number of nodes, and too low a recall repeats the search with
more overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import components, plus, stored, unite

THRESHOLD = 0.93
#: Nodes per shard aimed at, overlap included, and the most of a chunk; a task holds two chunks at most.
SHARD, CHUNK = 1500, 2500
MAX_CENTRES = 4096
#: Nodes that the centres are fitted on: this many per centre, at most this many in all.
SAMPLE_PER_CENTRE, MAX_SAMPLE = 20, 40_000
OVERLAPS = (2, 4, 8)
DEGREE, CANDIDATES, ALPHA = 20, 40, 1.2
#: Further candidates drawn from the whole chunk, for edges that lead out of dense groups.
FAR_CANDIDATES, MEDOIDS = 16, 8
BEAM, WIDTH = 16, 4
#: Nodes this much below the threshold are walked through in the range search.
SLACK = 0.04
AUDITED, MIN_RECALL = 256, 0.99


def usable(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, label, v) that can link: label and id not null, finite components, not all zero."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v")
    )


def _units(column) -> np.ndarray:
    """Rows of a list column as float32 unit vectors (of equal length)."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def fit_centres(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Unit centres by vector length, from nodes of smallest hash (a bounded sample) by spherical k-means."""
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    k = min(MAX_CENTRES, -(-largest * OVERLAPS[0] // SHARD))
    if k <= OVERLAPS[0]:
        return {}
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(min(MAX_SAMPLE, SAMPLE_PER_CENTRE * k)).select("dim", "v").toArrow()
    out = {}
    for dim in sorted(set(sample.column("dim").to_pylist())):
        x = _units(sample.filter(pc.equal(sample.column("dim"), dim)).column("v"))
        own = min(k, len(x) // 4)
        if own < 2:
            continue
        centres = x[np.random.default_rng(5).choice(len(x), own, replace=False)]
        for _ in range(8):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            lengths = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(lengths > 0, sums / np.maximum(lengths, 1e-9), centres)
        out[dim] = centres.astype(np.float32)
    return out


def _assign(nodes: DataFrame, centres: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """Rows (label, dim, shard, home, node, size, v), one per node and shard it joins."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                own = shared.value.get(int(dim))
                if own is None:
                    order = np.zeros((part.num_rows, 1), dtype=np.int32)
                else:
                    order = np.argsort(-(_units(part.column("v")) @ own.T), axis=1, kind="stable")[:, :overlap]
                width = order.shape[1]
                rows = part.take(pa.array(np.repeat(np.arange(part.num_rows), width)))
                home = np.tile(np.arange(width) == 0, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(order.ravel().astype(np.int32)), pa.array(home)], names=[*batch.schema.names, "shard", "home"]
                )

    return nodes.mapInArrow(run, plus(nodes, "shard int, home boolean"))


def _dealt(members: DataFrame) -> DataFrame:
    """members with (x, y): the pair of chunks a row is handled in; one pair unless a shard is crowded."""
    sizes = members.groupBy("label", "dim", "shard").count().where(F.col("count") > CHUNK)
    crowded = stored(sizes, "shards")
    share = F.coalesce(F.ceil(F.col("count") / CHUNK), F.lit(1)).cast("int")
    rows = members.join(crowded, ["label", "dim", "shard"], "left").withColumn("k", share).drop("count")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
    return rows.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("k", "other")


def _pruned(x: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours of every row of x, padded with -1.

    The nearest candidate is taken again and again; each one taken removes the candidates that
    are nearer to it, by a factor, than to the node itself. Candidates are the nearest rows and
    some drawn from all.
    """
    n = len(x)
    draw = np.random.default_rng(n)
    near = min(CANDIDATES, n - 1)
    out = np.full((n, DEGREE), -1, dtype=np.int32)
    if near < 1:
        return out
    for low in range(0, n, 512):
        rows = np.arange(low, min(n, low + 512))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -np.inf
        found = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        found = np.c_[found, draw.integers(0, n, (len(rows), FAR_CANDIDATES))]
        value = np.take_along_axis(sims, found, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        found, value = np.take_along_axis(found, order, axis=1), np.take_along_axis(value, order, axis=1)
        far = np.sqrt(np.maximum(2 - 2 * value, 0))
        among = np.einsum("ijd,ikd->ijk", x[found], x[found], optimize=True)
        among = np.sqrt(np.maximum(2 - 2 * among, 0))
        alive = value > -np.inf
        each = np.arange(len(rows))
        for k in range(DEGREE):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            out[rows[some], k] = found[each[some], pick[some]]
            alive[each, pick] = False
            alive &= ALPHA * among[each, pick] > far
    return out


def _build(group: pa.Table) -> pa.Table:
    ids = group.column("node").to_numpy()
    neighbours = _pruned(_units(group.column("v")))
    i, k = np.nonzero(neighbours >= 0)
    j = neighbours[i, k]
    # Both directions, so that every node can be reached from its neighbours.
    return pa.table({"node": np.r_[ids[i], ids[j]], "neighbour": np.r_[ids[j], ids[i]]})


def _medoids(x: np.ndarray) -> np.ndarray:
    """The node nearest to the mean, then again and again the one least like those taken."""
    taken = [int((x @ x.mean(axis=0)).argmax())]
    most = x @ x[taken[0]]
    while len(taken) < min(MEDOIDS, len(x)):
        taken.append(int(most.argmin()))
        most = np.maximum(most, x @ x[taken[-1]])
    return np.unique(taken)


def _in_range(x: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) of similarity about the threshold or more, by greedy and then range search."""
    n = len(x)
    degree = np.fromiter(map(len, graph), dtype=np.int64, count=n)
    first = np.cumsum(degree) - degree
    flat = np.concatenate(graph) if n else np.zeros(0, dtype=np.int64)
    entries = _medoids(x)
    hits = []
    for low in range(0, len(queries), 256):
        own = queries[low : low + 256]
        m = len(own)
        seen = np.zeros((m, n), dtype=bool)
        expanded = np.zeros((m, n), dtype=bool)
        sims = np.full((m, n), -2.0, dtype=np.float32)

        def visit(q, node, own=own, seen=seen, sims=sims):
            new = ~seen[q, node]
            pair = np.unique(q[new] * n + node[new])
            q, node = pair // n, pair % n
            seen[q, node] = True
            sims[q, node] = np.einsum("ij,ij->i", x[own[q]], x[node])

        def expand(q, node, expanded=expanded, visit=visit):
            expanded[q, node] = True
            count = degree[node]
            at = np.repeat(first[node] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            visit(np.repeat(q, count), flat[at])

        # A query is a node itself, so its own neighbours are a way in, too.
        visit(np.r_[np.repeat(np.arange(m), len(entries)), np.arange(m)], np.r_[np.tile(entries, m), own])
        beam = min(BEAM, n)
        while True:  # greedy: the best few not yet expanded among the best seen
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            value = np.take_along_axis(sims, best, axis=1)
            value[np.take_along_axis(expanded, best, axis=1)] = -2
            order = np.argsort(-value, axis=1)[:, :WIDTH]
            q, c = np.nonzero(np.take_along_axis(value, order, axis=1) > -2)
            if not len(q):
                break
            expand(q, best[q, order[q, c]])
        while True:  # outward: everything in range, or a little below it, is expanded
            q, node = np.nonzero((sims >= threshold - SLACK) & ~expanded)
            if not len(q):
                break
            expand(q, node)
        q, node = np.nonzero(sims >= threshold - 1e-4)
        hits.append((own[q], node))
    return (np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])) if hits else (np.zeros(0, dtype=np.int64),) * 2


COUNT, CROSS, EDGE = range(3)


def _search(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        ids, size = group.column("node").to_numpy(), group.column("size").to_numpy()
        own, home = group.column("own").to_numpy(), group.column("home").to_numpy(zero_copy_only=False)
        x0, y0 = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        units = _units(group.column("v"))
        order = np.argsort(ids)
        graph = []
        for some in group.column("neighbours").to_pylist():
            some = np.array(some or [], dtype=np.int64)
            at = order[np.minimum(np.searchsorted(ids[order], some), len(ids) - 1)]
            graph.append(at[ids[at] == some])
        q, p = _in_range(units, graph, np.flatnonzero(home), threshold)
        # Of two chunks only the pairs between them belong here.
        belongs = (q != p) & ((x0 == y0) | (own[q] != own[p]))
        q, p = q[belongs], p[belongs]
        exact = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        norms = np.sqrt(np.einsum("ij,ij->i", exact, exact))
        near = np.zeros(len(q), dtype=bool)
        for low in range(0, len(q), 100_000):
            a, b = q[low : low + 100_000], p[low : low + 100_000]
            near[low : low + 100_000] = np.einsum("ij,ij->i", exact[a], exact[b]) / (norms[a] * norms[b]) >= threshold
        pairs = np.unique(np.minimum(q[near], p[near]) * len(ids) + np.maximum(q[near], p[near]))
        a, b = pairs // len(ids), pairs % len(ids)
        inner = home[a] & home[b]
        counts = np.bincount(a[inner], weights=size[b[inner]], minlength=len(ids)) + np.bincount(b[inner], weights=size[a[inner]], minlength=len(ids))
        counted = np.flatnonzero(counts)
        labels = unite(np.arange(len(ids)), a, b)
        child = np.flatnonzero(labels != np.arange(len(ids)))
        ca, cb = a[~inner], b[~inner]
        zero = np.zeros
        return pa.table(
            {
                "kind": np.r_[np.full(len(counted), COUNT), np.full(len(ca), CROSS), np.full(len(child), EDGE)].astype(np.int32),
                "a": np.r_[ids[counted], ids[ca], ids[child]],
                "b": np.r_[ids[counted], ids[cb], ids[labels[child]]],
                "wa": np.r_[counts[counted].astype(np.int64), size[ca], zero(len(child), dtype=np.int64)],
                "wb": np.r_[zero(len(counted), dtype=np.int64), size[cb], zero(len(child), dtype=np.int64)],
            }
        )

    return run


def _found(nodes: DataFrame, centres: dict[int, np.ndarray], threshold: float, overlap: int) -> DataFrame:
    """Rows (kind, a, b, wa, wb): counts within a home, pairs across homes, edges of spanning forests."""
    dealt = stored(_dealt(_assign(nodes, centres, overlap)), "shards")
    key = ["label", "dim", "shard", "x", "y"]
    edges = dealt.select(*key, "node", "v").groupBy(*key).applyInArrow(_build, "node long, neighbour long")
    # At most DEGREE neighbours per shard and direction that a node takes part in.
    united = edges.groupBy("node").agg(F.collect_set("neighbour").alias("neighbours"))
    members = dealt.join(united, "node", "left")
    return stored(
        members.groupBy(*key).applyInArrow(_search(threshold), "kind int, a long, b long, wa long, wb long"), "found"
    )


def _links(found: DataFrame) -> DataFrame:
    """Rows (node, n): rows linked to each node, from counts within homes and distinct pairs across them."""
    across = found.where(F.col("kind") == CROSS)
    pairs = across.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), F.when(F.col("a") < F.col("b"), F.col("wa")).otherwise(F.col("wb")).alias("wlo"), F.when(F.col("a") < F.col("b"), F.col("wb")).otherwise(F.col("wa")).alias("whi")).distinct()
    each = pairs.select(F.col("lo").alias("node"), F.col("whi").alias("n")).unionByName(
        pairs.select(F.col("hi").alias("node"), F.col("wlo").alias("n"))
    )
    within = found.where(F.col("kind") == COUNT).select(F.col("a").alias("node"), F.col("wa").alias("n"))
    return each.unionByName(within).groupBy("node").agg(F.sum("n").alias("n"))


def _compared(threshold: float):
    """Function of two chunks of a label: counts of all their linked pairs, and edges of a spanning forest."""

    def run(group: pa.Table) -> pa.Table:
        ids, size, own = (group.column(c).to_numpy() for c in ("node", "size", "own"))
        within = group.column("x")[0].as_py() == group.column("y")[0].as_py()
        exact = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        norms = np.sqrt(np.einsum("ij,ij->i", exact, exact))
        units = exact / norms[:, None]
        counts, labels = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for row in range(0, len(ids), 256):
            i, j = np.nonzero(units[row : row + 256] @ units.T >= threshold - 1e-9)
            i += row
            on = (j > i) if within else (j > i) & (own[i] != own[j])
            i, j = i[on], j[on]
            near = np.einsum("ij,ij->i", exact[i], exact[j]) / (norms[i] * norms[j]) >= threshold
            i, j = i[near], j[near]
            np.add.at(counts, i, size[j])
            np.add.at(counts, j, size[i])
            labels = unite(labels, i, j)
        counted, child = np.flatnonzero(counts), np.flatnonzero(labels != np.arange(len(ids)))
        zero = np.zeros(len(child), dtype=np.int64)
        return pa.table(
            {
                "kind": np.r_[np.full(len(counted), COUNT), np.full(len(child), EDGE)].astype(np.int32),
                "a": np.r_[ids[counted], ids[child]],
                "b": np.r_[ids[counted], ids[labels[child]]],
                "wa": np.r_[counts[counted], zero],
                "wb": np.zeros(len(counted) + len(child), dtype=np.int64),
            }
        )

    return run


def _every_pair(nodes: DataFrame, threshold: float) -> DataFrame:
    """What _found returns, from comparing all nodes of a label, in pairs of chunks of bounded size."""
    chunks = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("k"))
    dealt = (
        nodes.join(chunks, ["label", "dim"])
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
        .select("label", "dim", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "size", "v")
    )
    compared = dealt.groupBy("label", "dim", "x", "y").applyInArrow(_compared(threshold), "kind int, a long, b long, wa long, wb long")
    return stored(compared, "found")


def recall(nodes: DataFrame, links: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Of the true links of a few nodes (chosen by hash, compared with all) what was found: the lesser of the
    share of all their links and the mean share per node, so that neither hubs nor lone pairs go unseen."""
    chosen = nodes.orderBy(F.xxhash64(F.col("node") + 1), "node").limit(audited).select("label", "dim", "node", "size", "v")
    some = chosen.toArrow()
    asked = {}
    for label, dim, node, v in zip(some["label"].to_pylist(), some["dim"].to_pylist(), some["node"].to_pylist(), some["v"].to_pylist(), strict=True):
        asked.setdefault((label, dim), []).append((node, np.array(v, dtype=np.float64)))
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        totals = {}
        for batch in batches:
            ids, size = batch.column("node").to_numpy(), batch.column("size").to_numpy()
            label, dim = np.array(batch.column("label").to_pylist()), batch.column("dim").to_numpy()
            for (one, d), queries in shared.value.items():
                at = np.flatnonzero((label == one) & (dim == d))
                if not len(at):
                    continue
                x = batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for node, v in queries:
                    near = (x @ (v / np.linalg.norm(v)) >= threshold) & (ids[at] != node)
                    totals[node] = totals.get(node, 0) + int(size[at[near]].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())], names=["node", "n"])

    true = nodes.select("node", "size", "label", "dim", "v").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    ids = nodes.sparkSession.createDataFrame([(n,) for n in some["node"].to_pylist()], "node long")
    got = {r["node"]: r["n"] for r in links.join(F.broadcast(ids), "node", "left_semi").collect()}
    wanted = {r["node"]: r["n"] for r in true.where("n > 0").collect()}  # as many rows as are audited, at most
    if not wanted:
        return 1.0
    shares = [min(got.get(node, 0), n) / n for node, n in wanted.items()]
    return min(sum(min(got.get(node, 0), n) for node, n in wanted.items()) / sum(wanted.values()), sum(shares) / len(shares))


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of rows (vec_id, embedding, label).

    Vectors of one label and length link at a cosine of threshold or more. n_links counts the
    other ids linked directly, component_id is the smallest id reachable, kept tells whether it is
    the row's own. Null ids, null labels and null, zero or non-finite vectors link with nothing; a
    null id has a null component and is kept. If rows share an id, the smallest (label, vector)
    among them speaks for it. The recall of the search is audited; where no overlap of the shards
    reaches MIN_RECALL, all vectors of a label are compared, in pairs of chunks.
    """
    cut = rows.select("vec_id", "embedding", "label")
    fine = usable(cut)
    if fine.groupBy("vec_id").count().where("count > 1").limit(1).count():
        fine = fine.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    members = fine
    nodes = stored(
        members.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("size")).withColumn("dim", F.size("v")), "nodes"
    )
    centres = fit_centres(nodes)
    for overlap in OVERLAPS if centres else OVERLAPS[:1]:
        found = _found(nodes, centres, threshold, overlap)
        links = stored(_links(found), "links")
        if recall(nodes, links, threshold) >= MIN_RECALL:
            break
    else:  # no graph was good enough
        found = _every_pair(nodes, threshold)
        links = stored(_links(found), "links")
    roots = components(found.where(F.col("kind") != COUNT).select("a", "b"))
    classes = (
        nodes.join(links, "node", "left")
        .join(roots, "node", "left")
        .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    )
    named = members.join(classes, ["label", "v"]).select("vec_id", "n_links", "component_id")
    out = cut.select(F.col("vec_id").cast("long").alias("vec_id")).join(named, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
