"""How far the sources of a language differ in their words, over a quadtree of the count matrix.

The matrix of a language has a row per source and a column per kept term; a cell is how often the
term occurs there. Columns are dealt to strips of bounded width, rows to blocks of bounded
height, and a task takes one strip of two row blocks. It holds the nonzero cells of its part as
a K-squared tree with K = 2: per level the quadrants that are not all zero. Two rows are compared
by going down both trees at once: where the quadrants of both are all zero, the price of a cell
is the same for all columns, so the quadrant is priced by its width without going further down;
at the leaves the cells that are nonzero in one row or both are priced one by one. Columns without
a cell in either block are never in a task and are priced by their number.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import steps, stored

MIN_DOCS = 10
TOP_TERMS = 10
#: Rows of a block and columns of a strip: a task has 2 * BLOCK rows and about STRIP columns.
BLOCK = 32
STRIP = 1024
#: Distinct terms that a task counts before it passes its counts on.
TERMS_KEPT = 200_000
#: Shares are in units of a thousand millionth, taken in two steps so that no product overflows.
UNIT_HIGH, UNIT_LOW = 10_000, 100_000
UNIT = UNIT_HIGH * UNIT_LOW

# Bytes that are no part of a term become spaces; A-Z become lower case.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and of all that is not ASCII, A-Z lower-cased, of a text in UTF-8."""
    return text.translate(_TABLE).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (lang, source, text) to (lang, source, term, n, docs), each possibly in several rows."""
    counts: dict[tuple[str, str], Counter[bytes]] = {}
    docs: dict[tuple[str, str], Counter[bytes]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), group in counts.items():
            held = docs[lang, source]
            for k in range(0, len(group), 100_000):
                words = list(islice(group, k, k + 100_000))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.string()),
                        pa.array([source] * len(words), pa.string()),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array([group[w] for w in words], pa.int64()),
                        pa.array([held[w] for w in words], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        counts.clear()
        docs.clear()

    for batch in steps(batches, "text"):
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            words = terms_of(text)
            if not words:
                continue
            counts.setdefault((lang, source), Counter()).update(words)
            docs.setdefault((lang, source), Counter()).update(set(words))
        if sum(map(len, counts.values())) > TERMS_KEPT:
            yield from out()
    yield from out()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * terms)), in two steps of long division."""
    m = F.greatest(total + 2 * terms, F.lit(1))
    high = (count + 2) * UNIT_HIGH
    quotient = F.call_function("div", high, m)
    return 1 + quotient * UNIT_LOW + F.call_function("div", (high % m) * UNIT_LOW, m)


def _share(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    quotient, rest = np.divmod((count + 2) * UNIT_HIGH, m)
    return 1 + quotient * UNIT_LOW + rest * UNIT_LOW // m


def distance(p, q):
    """floor((p - q)^2 / (p + q)) of shares as columns or as arrays."""
    if isinstance(p, Column):
        return F.call_function("div", (p - q) * (p - q), p + q)
    return (p - q) * (p - q) // (p + q)


class Quadtree:
    """The quadrants of a matrix that are not all zero, by level; level 0 has the cells."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, height: int):
        self.height = height
        self.levels = []
        for level in range(height + 1):
            codes = self.code(rows >> level, columns >> level, level)
            if level:
                codes = np.unique(codes)
            else:
                order = np.argsort(codes)
                codes, self.counts = codes[order], counts[order]
            self.levels.append(codes)

    def code(self, row, column, level: int):
        return (row << (self.height - level)) | column

    def find(self, row: np.ndarray, column: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each quadrant is not all zero, and its place among those."""
        codes, want = self.levels[level], self.code(row, column, level)
        at = np.minimum(np.searchsorted(codes, want), max(len(codes) - 1, 0))
        return (codes[at] == want) if len(codes) else np.zeros(len(want), dtype=bool), at


def compare(tree: Quadtree, first: range, second: range, m: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed distances of the rows of first to those of second over width columns, by joint descent.

    m has the denominator of every row's shares. Rows are numbered in one matrix; first and second
    are the same range or apart. Also returns how many quadrants were priced without descent.
    """
    tall = max(len(m) - 1, 0).bit_length()
    size = 1 << tall
    zero = _share(np.zeros(len(m), dtype=np.int64), m)
    apart = distance(zero[:, None], zero[None, :])
    sums = np.zeros((size, size), dtype=np.int64)
    a = b = c = np.zeros(1, dtype=np.int64)
    pruned = 0
    for level in range(tree.height, -1, -1):
        # Quadrants beyond the rows or columns there are hold no cell to price.
        real = (c << level) < width
        for rows, part in ((a, first), (b, second)):
            real &= (rows << level < part.stop) & ((rows + 1) << level > part.start)
        if first == second:
            real &= a <= b
        a, b, c = a[real], b[real], c[real]
        has_a, at_a = tree.find(a, c, level)
        has_b, at_b = tree.find(b, c, level)
        empty = ~has_a & ~has_b
        pruned += int(empty.sum())
        columns = np.minimum((c[empty] + 1) << level, width) - (c[empty] << level)
        high = min(level, tall)
        wide = np.zeros((size >> high, size >> high), dtype=np.int64)
        np.add.at(wide, (a[empty], b[empty]), columns)
        sums += np.repeat(np.repeat(wide, 1 << high, 0), 1 << high, 1)
        on = ~empty
        a, b, c = a[on], b[on], c[on]
        if level:
            a, b, c = (np.repeat(x << 1, 8) for x in (a, b, c))
            k = np.tile(np.arange(8), len(a) // 8)
            a, b, c = a + (k & 1), b + (k >> 1 & 1), c + (k >> 2)
    sums = sums[: len(m), : len(m)] * apart
    x = np.where(has_a[on], tree.counts[at_a[on]], 0) if len(tree.counts) else np.zeros(len(a), dtype=np.int64)
    y = np.where(has_b[on], tree.counts[at_b[on]], 0) if len(tree.counts) else np.zeros(len(a), dtype=np.int64)
    np.add.at(sums, (a, b), distance(_share(x, m[a]), _share(y, m[b])))
    return sums, pruned


def _priced(table: pa.Table) -> pa.Table:
    """The pairs of one strip of two row blocks; rows without a term only tell their denominator."""
    of = lambda name: table.column(name).to_numpy()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    row, marks = of("row"), table.column("term").is_null().to_numpy()
    numbers = np.unique(row[marks])
    m = np.zeros(len(numbers), dtype=np.int64)
    m[np.searchsorted(numbers, row[marks])] = of("m")[marks]
    rows, counts = np.searchsorted(numbers, row[~marks]), of("n")[~marks]
    coded = table.column("term").filter(pa.array(~marks)).combine_chunks().dictionary_encode()
    columns, width = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    # Terms that occur in the same rows stand side by side, so empty quadrants are large.
    held = np.zeros(width, dtype=np.uint64)
    np.bitwise_or.at(held, columns, np.uint64(1) << rows.astype(np.uint64))
    place = np.empty(width, dtype=np.int64)
    place[np.argsort(held, kind="stable")] = np.arange(width)
    height = max(width - 1, len(numbers) - 1, 0).bit_length()
    tree = Quadtree(rows, place[columns], counts, height)
    cut = len(numbers) if i == j else int((numbers // BLOCK == i).sum())
    first, second = range(cut), range(cut) if i == j else range(cut, len(numbers))
    sums, _ = compare(tree, first, second, m, width)
    a, b = np.triu_indices(len(numbers), 1)
    on = (a < first.stop) & (b >= second.start)
    a, b = a[on], b[on]
    n = len(a)
    return pa.table(
        {
            "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
            "a": numbers[a],
            "b": numbers[b],
            "value": sums[a, b],
            "width": np.full(n, width, dtype=np.int64),
        }
    )


class Audit(NamedTuple):
    #: Rows (lang, source, other, value, rank): every other source of the language, farthest first.
    pairs: DataFrame
    #: Rows (lang, source, term, value, rank): the terms that set a source apart from its language.
    terms: DataFrame


def _ranked(rows: DataFrame, item: str) -> DataFrame:
    window = Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    return rows.withColumn("rank", F.row_number().over(window)).select("lang", "source", item, "value", "rank")


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> Audit:
    """Distances between the sources of each language, and the terms that tell a source.

    Null languages, sources and texts are empty ones. A language keeps the terms in at least
    min_docs of its rows; every row is a document, also if ids repeat. Every (language, source)
    that occurs is a group, also without a kept term. Ties rank by the item's bytes. An empty table
    gives no rows, a source alone in its language no pair.
    """
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # One shuffle by term serves the counts of cells and the totals of terms.
    cells = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    cells = cells.select(
        "lang",
        "term",
        "source",
        "n",
        F.sum("n").over(of_term).alias("total"),
        F.sum("docs").over(of_term).alias("held"),
        (F.col("source") == F.min("source").over(of_term)).alias("once"),
    )
    cells = stored(cells.where(F.col("held") >= min_docs).drop("held"), "cells")
    langs = cells.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("once").alias("v"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    size = F.count("*").over(Window.partitionBy("lang"))
    groups = groups.select(
        "*",
        number.cast("long").alias("row"),
        F.ceil(size / BLOCK).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("v") / STRIP)).cast("int").alias("strips"),
    )
    groups = stored(groups, "groups")

    known = cells.join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("n_group"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
    telling = known.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    terms = _ranked(telling.select("lang", "source", "term", distance(F.col("p"), F.col("q")).alias("value")), "term")
    terms = terms.where(F.col("rank") <= top_terms)

    placed = known.select(
        "lang", F.expr("cast(pmod(xxhash64(term), strips) as int)").alias("strip"), "term", "row", "n", F.lit(0).cast("long").alias("m"), "blocks"
    )
    marks = groups.select(
        "lang",
        F.explode(F.expr("sequence(0, strips - 1)")).alias("strip"),
        F.lit(None).cast("string").alias("term"),
        "row",
        F.lit(0).cast("long").alias("n"),
        (F.col("n_group") + 2 * F.col("v")).alias("m"),
        "blocks",
    )
    met = placed.unionByName(marks).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    block = F.expr(f"cast(row div {BLOCK} as int)")
    met = met.select("lang", "strip", F.least(block, "other").alias("i"), F.greatest(block, "other").alias("j"), "term", "row", "n", "m")
    sums = met.groupBy("lang", "strip", "i", "j").applyInArrow(_priced, "lang string, a long, b long, value long, width long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("width").alias("width"))
    end = lambda at, name: groups.select(
        "lang",
        F.col("row").alias(at),
        F.col("source").alias(name),
        F.col("v").alias(f"{name}_v"),
        share(F.lit(0), F.col("n_group"), F.col("v")).alias(f"{name}_zero"),
    )
    both = sums.join(end("a", "x"), ["lang", "a"]).join(end("b", "y"), ["lang", "b"])
    # Terms that neither block of a task has were priced in none.
    value = F.col("value") + (F.col("x_v") - F.col("width")) * distance(F.col("x_zero"), F.col("y_zero"))
    ends = F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("other")), F.struct(F.col("y").alias("source"), F.col("x").alias("other")))
    pairs = both.select("lang", value.alias("value"), F.explode(ends).alias("ends")).select("lang", "ends.source", "ends.other", "value")
    return Audit(_ranked(pairs, "other"), terms)
