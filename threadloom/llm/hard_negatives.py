"""Hard negatives of anchor vectors, read from blocks that their zone maps cannot rule out.

Vectors become whole numbers and are written in the order of label and Hilbert curve, so near
vectors of a label lie in one block. A block is one row of a Parquet table: the least and
greatest value of every dimension (its zone map), and the vectors. For an anchor, interval
arithmetic over a zone map bounds the scores of all vectors of the block without reading them.

What is asked of an anchor is a window: the best k vectors whose score lies between two bounds.
Its positives are the best of its own label, and each positive opens a window for negatives of
other labels. A search first reads the most promising block of every anchor, which gives a
floor for each window; then the zone maps alone tell which regions of the table hold a block
that some window must read, the others are pruned from the scan, and in the regions read the
blocks that no window needs are passed over. Floors rise while a task reads.

Anchors are taken in groups of bounded size, one search per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import scratch, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
#: The curve runs through so many dimensions, those of greatest variance, with so many bits each.
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
#: Numbers of a block, of a region (one file) and of the anchors of one search.
BLOCK_NUMBERS, REGION_NUMBERS, GROUP_NUMBERS = 1 << 14, 1 << 24, 1 << 22
BLOCK_ROWS_BITS = 8
BLOCK_ROWS = 1 << BLOCK_ROWS_BITS
#: Vectors from this norm on take no part, so that scores and their order fit a long.
NORM_BITS = 27
#: Scores that one step holds.
STEP_SCORES = 1 << 21
LEAST, MOST = -(1 << 61), 1 << 61
NO_ID = np.iinfo(np.int64).max


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of whole numbers below 2**bits, by Skilling's transposition."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low, one = np.uint64(q - 1), np.uint64(q)
        for i in range(n):
            high = (x[i] & one) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(points.shape[0], dtype=np.uint64)
    q = 1 << (bits - 1)
    while n and q > 1:
        t ^= np.where((x[n - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= t
    key = np.zeros(points.shape[0], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n) if n else np.zeros((len(column), 0), dtype=np.int32)


def _runs(*columns: np.ndarray) -> Iterator[slice]:
    """Stretches of rows that are equal in all columns."""
    n = len(columns[0])
    new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])] if n else np.zeros(0, dtype=bool)
    cuts = np.r_[np.flatnonzero(new), n]
    return (slice(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _whole(scale: float):
    """From (id, label, anchor, vec) to the rows that take part, vec as whole numbers, and its length n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(3)
            if isinstance(vec, pa.ChunkedArray):
                vec = vec.combine_chunks()
            values = vec.flatten()
            numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            lengths = np.diff(vec.offsets.to_numpy())
            lengths = np.where(vec.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
            numbers = np.floor(np.where(np.isfinite(numbers), numbers, np.nan) * scale)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            norms = np.bincount(owner, weights=numbers * numbers, minlength=len(lengths))
            fit = vec.is_valid().to_numpy(zero_copy_only=False) & (norms < 2.0 ** (2 * NORM_BITS))
            for name in (0, 1):
                fit &= batch.column(name).is_valid().to_numpy(zero_copy_only=False)
            offsets = np.r_[0, np.cumsum(lengths[fit])].astype(np.int32)
            kept = numbers[fit[owner]].astype(np.int32)
            some = batch.filter(pa.array(fit))
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:3], pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept)), pa.array(lengths[fit].astype(np.int32))],
                names=["id", "label", "anchor", "vec", "n"],
            )

    return run


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of (vec, n) to sums of every dimension, one set per length and task."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        lengths = batch.column(1).to_numpy()
        for n in np.unique(lengths):
            x = _matrix(batch.column(0).filter(pa.array(lengths == n)), int(n)).astype(np.float64)
            own = [np.full(n, len(x), dtype=np.float64), x.sum(0), (x * x).sum(0), x.min(0), x.max(0)]
            if n in sums:
                old = sums[n]
                own = [*(a + b for a, b in zip(old[:3], own[:3], strict=True)), np.minimum(old[3], own[3]), np.maximum(old[4], own[4])]
            sums[n] = own
    for n, own in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, n, dtype=np.int32)), pa.array(np.arange(n, dtype=np.int32)), *map(pa.array, own)],
            names=["n", "at", "rows", "total", "squares", "least", "most"],
        )


def _keys(curves: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Adds the place on the curve; curves has the dimensions, least and greatest values by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, keys = batch.column(4).to_numpy(), np.zeros(batch.num_rows, dtype=np.int64)
            for n in np.unique(lengths):
                on = lengths == n
                if int(n) in curves:
                    at, least, most = curves[int(n)]
                    x = _matrix(batch.column(3).filter(pa.array(on)), int(n))[:, at]
                    cells = (x - least) * (1 << CURVE_BITS) / np.maximum(most - least + 1, 1)
                    keys[on] = hilbert(cells.astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*batch.schema.names, "key"])

    return run


BLOCKS = "block long, label long, n int, anchors int, lo binary, hi binary, ids binary, vecs binary, marks binary, region int"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted rows to blocks: vectors of one label and length, in the order of their ids."""
    number, open_rows = 0, None

    def block(rows: list) -> tuple:
        nonlocal number
        number += 1
        region, label, n, ids, marks, vecs = rows
        order = np.argsort(ids, kind="stable")
        vecs = np.ascontiguousarray(vecs[order])
        lo, hi = (f(0) if len(vecs) else vecs for f in (vecs.min, vecs.max))
        parts = (lo.astype(np.int32), hi.astype(np.int32), ids[order], vecs, marks[order])
        return (region << 33 | number, label, n, int(marks.sum()), *(p.tobytes() for p in parts), region)

    for batch in batches:
        ids, labels, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        lengths, out = batch.column(4).to_numpy(), []
        region = int(batch.column(6)[0].as_py()) if batch.num_rows else 0
        for run in _runs(labels, lengths):
            n, label = int(lengths[run.start]), int(labels[run.start])
            vecs = _matrix(batch.column(3).slice(run.start, run.stop - run.start), n)
            own, mine = ids[run], marks[run].astype(np.uint8)
            if open_rows and (open_rows[1], open_rows[2]) == (label, n):
                own, mine, vecs = (np.concatenate(x) for x in zip(open_rows[3:], (own, mine, vecs), strict=True))
            elif open_rows:
                out.append(block(open_rows))
            size = min(BLOCK_ROWS, max(8, BLOCK_NUMBERS // max(n, 1)))
            whole = len(own) // size * size
            for k in range(0, whole, size):
                out.append(block([region, label, n, *(x[k : k + size] for x in (own, mine, vecs))]))
            open_rows = [region, label, n, *(x[whole:] for x in (own, mine, vecs))] if whole < len(own) else None
        if out:
            yield _block_rows(out)
    if open_rows:
        yield _block_rows([block(open_rows)])


def _block_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.int32())
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def blocks_of(vectors: DataFrame) -> DataFrame:
    """The table of blocks, one file per region; vectors has (id, label, anchor, vec, n), ids unique."""
    spark = vectors.sparkSession
    sums = vectors.select("vec", "n").mapInArrow(_moments, "n int, at int, rows double, total double, squares double, least double, most double")
    sums = sums.groupBy("n", "at").agg(*(F.sum(c).alias(c) for c in ("rows", "total", "squares")), F.min("least").alias("least"), F.max("most").alias("most"))
    variance = F.col("squares") / F.col("rows") - (F.col("total") / F.col("rows")) ** 2
    first = F.row_number().over(Window.partitionBy("n").orderBy(variance.desc(), "at"))
    leading = sums.withColumn("first", first).where(F.col("first") <= CURVE_DIMENSIONS).orderBy("n", "first").collect()
    curves = {
        n: tuple(np.array([r[c] for r in leading if r["n"] == n]) for c in ("at", "least", "most")) for n in {r["n"] for r in leading}
    }
    numbers = sum(r["rows"] * r["n"] for r in leading if r["first"] == 1)
    regions = max(spark.sparkContext.defaultParallelism, int(numbers // REGION_NUMBERS) + 1)
    order = ["label", "n", "key", "id"]
    keyed = vectors.mapInArrow(_keys(curves), "id long, label long, anchor boolean, vec array<int>, n int, key long")
    dealt = keyed.repartitionByRange(regions, *order).sortWithinPartitions(*order).withColumn("region", F.spark_partition_id())
    path = scratch(spark, "blocks")
    dealt.mapInArrow(_pack, BLOCKS).write.partitionBy("region").parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


class Group:
    """Anchors of one length, and the windows asked of each; an array per field."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        self.ids, self.labels, self.vecs = ids, labels, vecs
        self.norm = float(np.sqrt((vecs.astype(np.float64) ** 2).sum(1).max(initial=0)))

    def ask(self, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> None:
        """Windows (anchor, window) of scores from low to high; k vectors of the same label or of others."""
        self.low, self.high, self.k, self.same = low, high, k, same
        self.floor = np.full(low.shape, LEAST, dtype=np.int64)

    def start(self) -> None:
        """In a task: what bounds and scores are computed from."""
        self.above = np.maximum(self.vecs, 0).astype(np.float64)
        self.below = np.minimum(self.vecs, 0).astype(np.float64)
        self.need = np.maximum(self.low, self.floor)

    def reach(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every anchor's scores with what lies between lo and hi, a column per block."""
        lo, hi = lo.T.astype(np.float64), hi.T.astype(np.float64)
        least, most = self.above @ lo + self.below @ hi, self.above @ hi + self.below @ lo
        return least - np.abs(least) * 1e-9 - 1, most + np.abs(most) * 1e-9 + 1

    def asks(self, labels: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a window of each anchor can hold a vector of each block."""
        may = (self.labels[:, None] == labels[None, :]) == self.same
        hit = np.zeros(may.shape, dtype=bool)
        for w in range(self.low.shape[1]):
            need, high = self.need[:, w, None], self.high[:, w, None]
            hit |= (most >= need) & (least <= high) & (need <= high)
        return may & hit


def _zone(batch: pa.RecordBatch, n: int, step: int = 16) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    labels = batch.column(batch.schema.get_field_index("label")).to_numpy()
    lo, hi = batch.column(batch.schema.get_field_index("lo")), batch.column(batch.schema.get_field_index("hi"))
    for k in range(0, batch.num_rows, step):
        part = slice(k, min(k + step, batch.num_rows))
        corner = [np.frombuffer(b"".join(c.slice(k, step).to_pylist()), dtype=np.int32).reshape(-1, n) if n else np.zeros((part.stop - k, 0)) for c in (lo, hi)]
        yield part, labels[part], *corner


def _promising(shared, n: int):
    """From zone maps to (anchor, block, region, most): the block of the highest bound for every anchor in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Group = shared.value
        group.start()
        best, where, region = np.full(len(group.ids), -np.inf), np.zeros(len(group.ids), dtype=np.int64), np.zeros(len(group.ids), dtype=np.int32)
        for batch in batches:
            blocks, regions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part, labels, lo, hi in _zone(batch, n):
                least, most = group.reach(lo, hi)
                most = np.where(group.asks(labels, least, most), most, -np.inf)
                k = most.argmax(1)
                own = most[np.arange(len(k)), k]
                more = own > best
                best[more], where[more], region[more] = own[more], blocks[part][k[more]], regions[part][k[more]]
        on = np.flatnonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(on), pa.array(where[on]), pa.array(region[on]), pa.array(best[on])], names=["a", "block", "region", "most"]
        )

    return run


def _needed(shared, n: int):
    """From zone maps to (block, region, asked): the blocks that a window must read, and by how many anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Group = shared.value
        group.start()
        for batch in batches:
            asked = [group.asks(labels, *group.reach(lo, hi)).sum(0) for _, labels, lo, hi in _zone(batch, n)]
            asked = np.concatenate(asked) if asked else np.zeros(0, dtype=np.int64)
            on = np.flatnonzero(asked)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(on)) for k in (0, 1)), pa.array(asked[on].astype(np.int64))], names=["block", "region", "asked"]
            )

    return run


def _best(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of every row, higher scores first, then smaller ids; ids ascend along the columns."""
    behind = np.arange(scores.shape[1] - 1, -1, -1, dtype=np.int64)
    keys = np.where(fits, (scores << BLOCK_ROWS_BITS) | behind, np.iinfo(np.int64).min)
    if keys.shape[1] > k:
        keys = np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:]
    keys = -np.sort(-(keys + 1), axis=1) - 1
    none = keys < (LEAST << 1)
    at = scores.shape[1] - 1 - (keys & (BLOCK_ROWS - 1))
    return np.where(none, LEAST, keys >> BLOCK_ROWS_BITS), np.where(none, NO_ID, ids[np.where(none, 0, at)])


def _search(shared, n: int, only=None):
    """From blocks to (a, w, score, id): the best vectors of every window among a task's blocks.

    only, if given, tells which anchors read which block; else zone maps and floors do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Group = shared.value
        group.start()
        k, windows = group.k, group.low.shape[1]
        scores = np.full((len(group.ids), windows, k), LEAST, dtype=np.int64)
        found = np.full(scores.shape, NO_ID, dtype=np.int64)
        exact = {np.float32: group.vecs.astype(np.float32), np.float64: None, np.int64: None}
        chosen = only.value if only else None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            payload = [batch.column(batch.schema.get_field_index(c)) for c in ("ids", "vecs")]
            for part, labels, lo, hi in _zone(batch, n):
                asked = None if chosen else group.asks(labels, *group.reach(lo, hi))
                for j, at in enumerate(range(part.start, part.stop)):
                    active = chosen.get(int(blocks[at]), ()) if chosen else np.flatnonzero(asked[:, j])
                    if not len(active):
                        continue
                    ids = np.frombuffer(payload[0][at].as_py(), dtype=np.int64)
                    vecs = np.frombuffer(payload[1][at].as_py(), dtype=np.int32).reshape(len(ids), n)
                    bound = group.norm * float(np.sqrt((vecs.astype(np.float64) ** 2).sum(1).max(initial=0)))
                    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
                    if exact[kind] is None:
                        exact[kind] = group.vecs.astype(kind)
                    right = vecs.astype(kind).T
                    step = max(1, STEP_SCORES // len(ids))
                    for s in range(0, len(active), step):
                        some = active[s : s + step]
                        products = (exact[kind][some] @ right).astype(np.int64)
                        most, least = products.max(1), products.min(1)
                        for w in range(windows):
                            need, high = group.need[some, w], group.high[some, w]
                            on = np.flatnonzero((most >= need) & (least <= high) & (need <= high))
                            if not len(on):
                                continue
                            mine, own = some[on], products[on]
                            fits = (own >= need[on, None]) & (own <= high[on, None])
                            if group.same:
                                fits &= group.ids[mine, None] != ids[None, :]
                            new, who = _best(own, fits, ids, k)
                            both, names = np.concatenate([scores[mine, w], new], 1), np.concatenate([found[mine, w], who], 1)
                            order = np.lexsort((names, -both), axis=1)[:, :k]
                            both, names = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
                            scores[mine, w], found[mine, w] = both, names
                            # A later vector of the floor's score can still win by its id.
                            group.need[mine, w] = np.maximum(group.need[mine, w], both[:, -1])
        a, w, r = np.nonzero(found != NO_ID)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(w.astype(np.int32)), pa.array(scores[a, w, r]), pa.array(found[a, w, r])], names=["a", "w", "score", "id"]
        )

    return run


HITS = "a long, w int, score long, id long"


def _top(hits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("a", "w").orderBy(F.desc("score"), "id"))
    return hits.withColumn("place", place).where(F.col("place") <= k)


def search(blocks: DataFrame, group: Group) -> DataFrame:
    """Rows (a, w, score, id, place) of the best vectors of every window; a counts anchors, w windows."""
    spark, n = blocks.sparkSession, group.vecs.shape[1]
    blocks = blocks.where(F.col("n") == n)
    zones = blocks.select("block", "region", "label", "lo", "hi")
    shared = spark.sparkContext.broadcast(group)
    guess = zones.mapInArrow(_promising(shared, n), "a long, block long, region int, most double")
    guess = guess.groupBy("a").agg(F.max_by(F.struct("block", "region"), F.struct("most", "block")).alias("at")).select("a", "at.*").toArrow()
    if not guess.num_rows:
        return spark.createDataFrame([], f"{HITS}, place int")
    a, block, region = (guess.column(c).to_numpy() for c in range(3))
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0])
    chosen = {int(block[o[0]]): np.sort(a[o]) for o in np.split(order, cuts[1:])}
    only = spark.sparkContext.broadcast(chosen)
    read = blocks.where(F.col("region").isin([int(r) for r in np.unique(region)])).select("block", "label", "lo", "hi", "ids", "vecs")
    kth = _top(read.mapInArrow(_search(shared, n, only), HITS), group.k).where(F.col("place") == group.k).select("a", "w", "score").toArrow()
    group.floor[kth.column(0).to_numpy(), kth.column(1).to_numpy()] = kth.column(2).to_numpy()
    shared.unpersist()
    floored = spark.sparkContext.broadcast(group)
    needed = zones.mapInArrow(_needed(floored, n), "block long, region int, asked long")
    regions = [r["region"] for r in needed.select("region").distinct().collect()]
    read = blocks.where(F.col("region").isin(regions)).select("block", "label", "lo", "hi", "ids", "vecs")
    return _top(read.mapInArrow(_search(floored, n), HITS), group.k)


def _anchors(n: int):
    """From blocks to (id, label, vec as bytes) of the anchors in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, out = batch.column(0).to_pylist(), []
            for label, ids, vecs, marks in zip(labels, *(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                ids = np.frombuffer(ids, dtype=np.int64)
                vecs = np.frombuffer(vecs, dtype=np.int32).reshape(len(ids), n)
                out += [(int(ids[k]), label, vecs[k].tobytes()) for k in np.flatnonzero(np.frombuffer(marks, dtype=np.uint8))]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "label", "vec"])

    return run


def _groups(blocks: DataFrame) -> Iterator[Group]:
    """The anchors, whole regions together up to GROUP_NUMBERS numbers."""
    held = blocks.where("anchors > 0").groupBy("n", "region").agg(F.sum("anchors").alias("anchors")).orderBy("n", "region").collect()
    runs: list[tuple[int, list[int], int]] = []
    for n, region, anchors in held:
        if runs and runs[-1][0] == n and runs[-1][2] + anchors * n <= GROUP_NUMBERS:
            runs[-1][1].append(region)
            runs[-1] = (n, runs[-1][1], runs[-1][2] + anchors * n)
        else:
            runs.append((n, [region], anchors * n))
    for n, regions, _ in runs:
        part = blocks.where((F.col("n") == n) & (F.col("anchors") > 0) & F.col("region").isin(regions))
        table = part.select("label", "ids", "vecs", "marks").mapInArrow(_anchors(n), "id long, label long, vec binary").toArrow()
        vecs = np.frombuffer(b"".join(table.column("vec").to_pylist()), dtype=np.int32).reshape(table.num_rows, n)
        yield Group(table.column("id").to_numpy(), table.column("label").to_numpy(), vecs)


def _unique(vectors: DataFrame) -> DataFrame:
    """One row per id: of rows that share one, the least by label and numbers."""
    again = stored(vectors.groupBy("id").count().where("count > 1").select("id"), "again")
    if again.isEmpty():
        return vectors
    some = vectors.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vec", "anchor", "n")).alias("row"))
    return vectors.join(again, "id", "left_anti").unionByName(some.select("id", "row.label", "row.anchor", "row.vec", "row.n"))


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Numbers are scaled and rounded down; a score is the inner product. Positives are the best rows of
    an anchor's label; negatives of a positive are the best rows of other labels whose score is from
    low to high hundredths of the positive's, so positives of a negative score have none. Ties go to
    smaller ids. Rows with a null id, label or vector, a null or non-finite number, or a norm of 2**27
    or more after scaling take no part; only vectors of the same length are compared; rows that
    share an id are one row, the least by label and numbers. No anchor gives no row.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vec_col).cast("array<double>").alias("vec"),
    )
    whole = stored(rows.mapInArrow(_whole(scale), "id long, label long, anchor boolean, vec array<int>, n int"), "vectors")
    blocks = blocks_of(_unique(whole))
    path = scratch(spark, "mined")
    spark.createDataFrame([], MINED).write.parquet(path)
    for group in _groups(blocks):
        group.ask(np.full((len(group.ids), 1), LEAST), np.full((len(group.ids), 1), MOST), positives, True)
        best = search(blocks, group).toArrow()
        a, score, ids, place = (best.column(c).to_numpy() for c in ("a", "score", "id", "place"))
        shape = (len(group.ids), positives)
        low_of, high_of = np.zeros(shape, dtype=np.int64), np.full(shape, LEAST, dtype=np.int64)
        who, theirs = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        low_of[a, place - 1], high_of[a, place - 1] = -(-low * score // 100), high * score // 100
        who[a, place - 1], theirs[a, place - 1] = ids, score
        group.ask(low_of, high_of, negatives, False)
        hits = search(blocks, group)
        names = spark.createDataFrame(
            pa.table({"a": a, "w": (place - 1).astype(np.int32), "anchor_id": group.ids[a], "positive_id": ids, "positive_score": score})
        )
        mined = hits.join(names, ["a", "w"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        mined.write.mode("append").parquet(path)
    return spark.read.schema(MINED).parquet(path)
