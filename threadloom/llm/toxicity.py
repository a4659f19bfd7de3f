"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled texts gives the examples; all their words are the vocabulary. Document
frequencies count over all documents. A word's weight is its inverse document frequency times
a class weight, which rises smoothly with how unevenly toxic and other examples hold it and is never
zero, so every text that shares a word with an example is compared with it. The examples form an
inverted index whose postings are cut into blocks of neighbouring examples; per term and block the
largest weight is known, so the sum of these over a text's terms bounds every cosine in the
block. The blocks of highest bound are scored first, then all those whose bound reaches the k-th
best cosine; the others cannot hold a nearer example. The neighbours' votes, weighted by cosine
and by how many labelled texts an example stands for, are mapped to a probability that is
fitted on the examples, each scored without itself. Texts without a word of any example get the
rate of toxic texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import steps, texts_of

#: Labelled texts per class that become examples.
EXAMPLES_PER_CLASS = 2000
#: The class weight of a word that tells nothing, and the chi-squared at which half of the rest is reached.
PLAIN, HALF_CHI2 = 0.005, 30.0
#: An example of cosine 1 weighs 1 / COPY.
COPY = 0.02
NEIGHBOURS = 15
BLOCK = 32
#: Blocks of highest bound that are scored first.
FIRST_BLOCKS = 4
#: So many of the terms that most examples hold are kept as rows of a matrix.
FREQUENT = 512
#: Texts whose frequent terms are multiplied at once.
TOGETHER = 64
EVIDENCE = 3
THRESHOLD = 0.3
CACHE = 20_000

_WORD = re.compile(r"[^\W\d_]+")


class Index(NamedTuple):
    """Examples, ordered so that similar ones share blocks, and their postings by term and block."""

    terms: dict[str, int]
    #: Weight of each term, and of a word that no example holds.
    term_weights: np.ndarray
    other_weight: float
    ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    #: Row of each term in the matrix of frequent terms by examples, -1 for the others, which have postings.
    row: np.ndarray
    frequent: np.ndarray
    #: Entries of term t: term_starts[t] to term_starts[t + 1], one per block that holds it.
    term_starts: np.ndarray
    blocks: np.ndarray
    highest: np.ndarray
    #: Postings of entry e: entry_starts[e] to entry_starts[e + 1].
    entry_starts: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    base: float
    slope: float
    offset: float


def _counts(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").lower()))


def _vector(counts: Counter[str], index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the index and their weights in a vector of length one, to which other words belong too."""
    get = index.terms.get
    terms = np.fromiter((get(w, -1) for w in counts), dtype=np.int64, count=len(counts))
    damped = 1 + np.log(np.fromiter(counts.values(), dtype=float, count=len(counts)))
    known = terms >= 0
    weights = damped * np.where(known, index.term_weights[terms] if len(index.term_weights) else 0.0, index.other_weight)
    # In the order of terms, so that equal counts give equal sums.
    order = np.argsort(terms[known], kind="stable")
    return terms[known][order], (weights[known] / np.sqrt(np.sort(weights * weights).sum()))[order]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start to before its end, one after another."""
    sizes = ends - starts
    return np.repeat(ends - np.cumsum(sizes), sizes) + np.arange(sizes.sum())


def common(index: Index, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The part of the frequent terms in the cosines of texts (rows) with all examples."""
    wide = np.zeros((len(vectors), len(index.frequent)))
    for k, (terms, weights) in enumerate(vectors):
        row = index.row[terms]
        on = row >= 0
        wide[k, row[on]] = weights[on]
    return wide @ index.frequent


def nearest(
    index: Index, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1, part: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The k examples of highest positive cosine, ties by id, exactly; without is one to leave out.

    part is the text's row of common(), if that is known.
    """
    n = len(index.ids)
    if part is None:
        part = common(index, [(terms, weights)])[0]
    rare = index.row[terms] < 0
    first, last = index.term_starts[terms[rare]], index.term_starts[terms[rare] + 1]
    entries, own = _ranges(first, last), np.repeat(weights[rare], last - first)
    blocks = index.blocks[entries]
    n_blocks = -(-n // BLOCK)
    bounds = np.bincount(blocks, own * index.highest[entries], minlength=n_blocks)
    bounds = bounds + np.r_[part, np.zeros(n_blocks * BLOCK - n)].reshape(-1, BLOCK).max(axis=1)

    def scored(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        on = chosen[blocks]
        begins, ends = index.entry_starts[entries[on]], index.entry_starts[entries[on] + 1]
        at = _ranges(begins, ends)
        scores = part + np.bincount(index.examples[at], np.repeat(own[on], ends - begins) * index.weights[at], minlength=n)
        if without >= 0:
            scores[without] = 0
        found = np.flatnonzero((scores > 0) & np.repeat(chosen, BLOCK)[:n])
        return found, scores[found]

    chosen = np.zeros(n_blocks, dtype=bool)
    chosen[np.argsort(-bounds, kind="stable")[:FIRST_BLOCKS]] = True
    found, scores = scored(chosen)
    kth = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 0.0
    rest = ~chosen & (bounds >= kth - 1e-9) & (bounds > 0)
    if rest.any():
        more, further = scored(rest)
        found, scores = np.r_[found, more], np.r_[scores, further]
    if len(scores) > k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        found, scores = found[near], scores[near]
    order = np.lexsort((index.ids[found], -scores.round(12)))[:k]
    return found[order], scores[order]


def _vote(index: Index, found: np.ndarray, cosines: np.ndarray) -> float:
    # A copy of an example, however rare its kind, outweighs many that are merely alike.
    weights = index.stands_for[found] * cosines**2 / (1 + COPY - cosines**2)
    # One example's worth of the rate without any word keeps lone weak neighbours from deciding.
    return float((weights @ index.toxic[found] + 0.1 * index.base) / (weights.sum() + 0.1))


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on x with a light ridge: slope, offset."""
    a = np.zeros(2)
    design = np.c_[x, np.ones(len(x))]
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ a))
        slope = design.T @ (weights * (p - y)) + 1e-2 * a
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        a -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a[0]), 0.0), float(a[1])


def _examples(docs: DataFrame, labels: DataFrame, train: Column, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """Sampled labelled texts (id, text, toxic) and how many labelled ids each stands for, by class."""
    marked = labels.where(train & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    # A limit per class lets every task cut its rows before they meet.
    toxic, clean = (
        marked.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (1, 0)
    )
    chosen = toxic.unionByName(clean)
    # At most 2 * per_class rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    return rows, {k: max(1.0, n / per_class) for k, n in sizes.items()}


def _frequencies(docs: DataFrame, terms: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, held, n = shared.value, np.zeros(len(shared.value), dtype=np.int64), 0
        for batch in steps(batches, "text"):
            n += batch.num_rows
            for x in batch.column(0).to_pylist():
                if x:
                    own = [terms[w] for w in set(_WORD.findall(x.lower())) if w in terms]
                    held[own] += 1
        on = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[on, -1].astype(np.int32)), pa.array(np.r_[held[on], n])], names=["term", "n"])

    counts = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = np.zeros(len(terms) + 1, dtype=np.int64)
    table = counts.toArrow()  # one row per term of the examples
    by_term[table["term"].to_numpy()] = table["n"].to_numpy()
    return by_term[:-1].astype(float), int(by_term[-1])


def _class_weights(held: list[Counter[str]], toxic: np.ndarray, terms: dict[str, int]) -> np.ndarray:
    """From PLAIN for words that toxic and other examples hold alike, rising with chi-squared."""
    counts = np.zeros((2, len(terms)))
    for words, y in zip(held, toxic, strict=True):
        counts[int(y), [terms[w] for w in words]] += 1
    (b, a), n = counts, len(toxic)
    positives = toxic.sum()
    c, d = positives - a, n - positives - b
    chi2 = n * (a * d - b * c) ** 2 / (max(positives * (n - positives), 1) * (a + b) * (c + d) + 1e-9)
    return PLAIN + (1 - PLAIN) * chi2**2 / (chi2**2 + HALF_CHI2**2)


def fit(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = EXAMPLES_PER_CLASS) -> Index:
    """Build the index from up to per_class labelled texts of each class, chosen by hash of doc_id.

    labels has doc_id and toxic (0 or 1, others ignored); an id labelled twice is toxic if once so.
    """
    rows, stands_for = _examples(docs, labels, train, per_class)
    # At most 2 * per_class texts; only their counts are kept.
    sample = rows.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int"), "text").toLocalIterator()
    got = [(r["id"], r["toxic"], c) for r in sample if (c := _counts(r["text"]))]
    got.sort(key=lambda x: (x[0], x[1], sorted(x[2].items())))
    terms = {w: k for k, w in enumerate(sorted({w for _, _, c in got for w in c}))}
    counted, n = _frequencies(docs, terms)
    toxic = np.array([y for _, y, _ in got], dtype=float)
    term_weights = (np.log((1 + n) / (1 + counted)) + 1) * _class_weights([c for _, _, c in got], toxic, terms) if got else np.zeros(0)
    # Sorting by the words of greatest weight puts similar examples into the same blocks.
    leading = [sorted(sorted((-term_weights[terms[w]], terms[w]) for w in c)[:8]) for _, _, c in got]
    got = [got[k] for k in sorted(range(len(got)), key=lambda k: (leading[k], k))]
    toxic = np.array([y for _, y, _ in got], dtype=float)
    weight = np.array([stands_for[y] for _, y, _ in got])
    base = float((weight @ toxic + 0.5) / (weight.sum() + 10)) if got else 0.05
    index = Index(
        terms, term_weights, (np.log((1 + n) / 2) + 1) * PLAIN, np.array([i for i, _, _ in got], dtype=np.int64), toxic, weight,
        *[np.zeros(0, dtype=np.int64)] * 8, base, 0.0, 0.0,
    )
    if not got:
        return index
    vectors = [_vector(c, index) for _, _, c in got]
    term = np.concatenate([t for t, _ in vectors])
    example = np.repeat(np.arange(len(got)), [len(t) for t, _ in vectors])
    values = np.concatenate([w for _, w in vectors])
    order = np.lexsort((example, term))
    term, example, values = term[order], example[order], values[order]
    held = np.bincount(term, minlength=len(terms))
    often = np.argsort(-held, kind="stable")[:FREQUENT]
    row = np.full(len(terms), -1, dtype=np.int64)
    row[often] = np.arange(len(often))
    matrix = np.zeros((len(often), len(got)))
    in_matrix = row[term] >= 0
    matrix[row[term[in_matrix]], example[in_matrix]] = values[in_matrix]
    term, example, values = term[~in_matrix], example[~in_matrix], values[~in_matrix]
    block = example // BLOCK
    first = np.flatnonzero(np.r_[len(term) > 0, (term[1:] != term[:-1]) | (block[1:] != block[:-1])][: len(term)])
    index = index._replace(
        row=row,
        frequent=matrix,
        term_starts=np.searchsorted(term[first], np.arange(len(terms) + 1)),
        blocks=block[first],
        highest=np.maximum.reduceat(values, first) if len(first) else np.zeros(0),
        entry_starts=np.r_[first, len(term)],
        examples=example,
        weights=values,
    )
    votes = []
    for at in range(0, len(vectors), TOGETHER):
        parts = common(index, vectors[at : at + TOGETHER])
        for k, part in enumerate(parts, at):
            votes.append(_vote(index, *nearest(index, *vectors[k], NEIGHBOURS, without=k, part=part)))
    slope, offset = _logistic(np.array(votes), index.toxic, index.stands_for)
    return index._replace(slope=slope, offset=offset)


def judge(index: Index, texts: list[str | None]) -> list[tuple[float, list[int], list[float]]]:
    """Scores of texts, and the nearest examples with their cosines."""
    none = (np.zeros(0, dtype=np.int64), np.zeros(0))
    out = []
    for at in range(0, len(texts), TOGETHER):
        counts = [_counts(text) for text in texts[at : at + TOGETHER]]
        vectors = [_vector(c, index) if c and len(index.ids) else none for c in counts]
        parts = common(index, vectors) if len(index.ids) else [None] * len(vectors)
        for (terms, weights), part in zip(vectors, parts, strict=True):
            if not len(terms):
                out.append((index.base, [], []))
                continue
            found, cosines = nearest(index, terms, weights, NEIGHBOURS, part=part)
            p = 1 / (1 + np.exp(-(index.slope * _vote(index, found, cosines) + index.offset)))
            out.append((float(p), index.ids[found[:EVIDENCE]].tolist(), cosines[:EVIDENCE].round(6).tolist()))
    return out


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score, predicted, evidence, cosines), one per row of docs, from the whole text alone.

    Null and empty texts get the base rate and no evidence; repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen = shared.value, {}
        for batch in steps(batches, "text"):
            texts = batch.column(1).to_pylist()
            marks = [xxhash.xxh3_128_digest(x or b"") for x in texts_of(batch, "text")]
            if len(seen) > CACHE:
                seen.clear()
            unseen = {m: x for m, x in zip(marks, texts, strict=True) if m not in seen}
            seen.update(zip(unseen, judge(index, list(unseen.values())), strict=True))
            out = [seen[m] for m in marks]
            scores = [s for s, _, _ in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array([e for _, e, _ in out], pa.list_(pa.int64())), pa.array([c for _, _, c in out], pa.list_(pa.float64()))],
                names=["id", "score", "predicted", "evidence", "cosines"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, score double, predicted int, evidence array<long>, cosines array<double>")
