"""Language identification in two levels: family, then one-versus-one within the family.

Features are rates of hashed letter n-grams (one to three letters, lower-cased, anything but a
letter as a space). Linear support vector machines are fitted on a bounded sample of labelled
texts: one against the rest per family, one per pair of languages of a family. Every whole
text is then scored in Arrow batches; a decision is the mean weight of the text's n-grams.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import plus, steps

DIM = 1 << 12
#: Labelled texts per language that the classifiers are fitted on.
SAMPLE_PER_LANGUAGE = 300
EPOCHS = 30
PIECE = 1 << 20
UNDETERMINED = "und"

# ISO 639-1 codes by family. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky tt",
    "indo-aryan": "hi ur bn mr gu pa ne",
    "semitic": "ar he mt am",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


class _Grams:
    """Hashed n-grams of texts, in pieces of bounded size."""

    def __init__(self):
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        self.codes = np.where(letters, np.arange(0x110000), 0x20).astype(np.uint32)

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (text index, feature), one pair of arrays per piece and gram length."""
        texts = [t.lower() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for at in range(0, len(data), PIECE):
            low = max(0, at - 2)
            own = self.codes[data[low : at + PIECE]]
            where = np.flatnonzero(own[at - low :] != 0x20) + (at - low)
            if not len(where):
                continue
            doc = np.searchsorted(ends, where + low, side="right")
            gram = np.zeros(len(where), dtype=np.uint32)
            for back in range(3):
                gram = gram * np.uint32(0x9E3779B1) + (own[np.maximum(where - back, 0)] + np.uint32(back << 21)) * np.uint32(0x85EBCA6B)
                yield doc, (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - 12)


class Model(NamedTuple):
    """weights[k], bias[k] decide about heads[k]: a family, or a pair of languages."""

    families: dict[str, list[str]]
    heads: list[tuple[str, ...]]
    weights: np.ndarray
    bias: np.ndarray


def _texts(batch) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def _rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = _Grams()
    for batch in steps(batches, "text", 1 << 20):
        n = batch.num_rows
        sums = np.zeros(n * DIM)
        for doc, feature in grams(_texts(batch)):
            sums += np.bincount(doc * DIM + feature, minlength=n * DIM)
        sums = sums.reshape(n, DIM)
        rates = (sums / np.maximum(sums.sum(axis=1, keepdims=True), 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([r.tobytes() for r in rates], pa.binary())], names=["lang", "rates"]
        )


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0) -> np.ndarray:
    """Dual coordinate descent for the L2-loss linear SVM; x has a last column of ones."""
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    # Both classes weigh the same, however many examples they have.
    share = np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2
    diagonal = 1 / (2 * cost * share)
    squares = (x * x).sum(axis=1) + diagonal
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(y)):
            slope = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / squares[i], 0.0)
            w += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
    return w


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on up to per_language texts of each language among the rows that train selects.

    The sample is those of smallest hash of the id, so it is the same on every run; what
    reaches the driver is one vector of DIM rates per sampled text.
    """
    some = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(id_col), id_col))
    chosen = some.select(id_col, "lang").withColumn("rank", rank).where(F.col("rank") <= per_language).select(id_col).distinct()
    # Ids of at most per_language rows for each language.
    sample = some.join(F.broadcast(chosen), id_col, "left_semi").select("text", "lang").mapInArrow(_rates, "lang string, rates binary")
    rows = [(r["lang"], np.frombuffer(r["rates"], dtype=np.float32)) for r in sample.toLocalIterator()]
    rows = sorted(((lang, x) for lang, x in rows if x.any()), key=lambda r: (r[0], r[1].tobytes()))
    families = defaultdict(list)
    for lang in sorted({lang for lang, _ in rows}):
        families[family_of(lang)].append(lang)
    families = dict(sorted(families.items()))
    x = np.stack([r for _, r in rows]).astype(np.float64) if rows else np.zeros((0, DIM))
    scale = 1 / (np.sqrt((x * x).mean(axis=0)) + 1e-4) if rows else np.ones(DIM)
    scale /= np.sqrt(DIM) / 4
    x = np.c_[x * scale, np.ones(len(x))]
    langs = np.array([lang for lang, _ in rows])
    of = np.array([family_of(lang) for lang, _ in rows])
    heads, fitted = [], []
    if len(families) > 1:
        for family in families:
            heads.append((family,))
            fitted.append(_svm(x, np.where(of == family, 1.0, -1.0)))
    for members in families.values():
        for a, b in combinations(members, 2):
            own = (langs == a) | (langs == b)
            heads.append((a, b))
            fitted.append(_svm(x[own], np.where(langs[own] == a, 1.0, -1.0)))
    fitted = np.stack(fitted) if fitted else np.zeros((0, DIM + 1))
    return Model(families, heads, (fitted[:, :-1] * scale).astype(np.float32), fitted[:, -1])


def _decide(model: Model, margins: np.ndarray, known: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of every text from its margins; known is False where there is no letter."""
    n = len(known)
    sure = 1 / (1 + np.exp(-2 * np.clip(margins, -30, 30)))
    names = list(model.families)
    if len(names) > 1:
        family = margins[:, : len(names)].argmax(axis=1)
        score = sure[np.arange(n), family]
    else:
        family, score = np.zeros(n, dtype=int), np.ones(n)
    lang = np.full(n, UNDETERMINED, dtype=object)
    for f, name in enumerate(names):
        members = model.families[name]
        votes = np.zeros((n, len(members)))
        weak = np.full((n, len(members)), 1.0)
        for k, head in enumerate(model.heads):
            if len(head) == 2 and head[0] in members and head[1] in members:
                a, b = members.index(head[0]), members.index(head[1])
                votes[:, a] += margins[:, k] >= 0
                votes[:, b] += margins[:, k] < 0
                # The weakest decision for a language breaks ties and gives its score.
                weak[:, a] = np.minimum(weak[:, a], sure[:, k])
                weak[:, b] = np.minimum(weak[:, b], 1 - sure[:, k])
        best = (votes + weak / 2).argmax(axis=1)
        here = (family == f) & known
        lang[here] = np.array(members, dtype=object)[best[here]]
        score = np.where(here, score * weak[np.arange(n), best], score)
    return lang.tolist(), np.where(known & (len(names) > 0), score, 0.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the predicted language and its score (0 to 1) in two more columns, from the whole text alone.

    The language is a learned one, or und with score 0 where the text is null, has no letter or
    nothing was learned. Columns of docs named as in into are replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, grams = shared.value, _Grams()
        for batch in steps(batches, text_col):
            n = batch.num_rows
            sums, counts = np.zeros((n, len(model.heads))), np.zeros(n)
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            for doc, feature in grams(texts):
                counts += np.bincount(doc, minlength=n)
                for k, weights in enumerate(model.weights):
                    sums[:, k] += np.bincount(doc, weights=weights[feature], minlength=n)
            margins = sums / np.maximum(counts, 1)[:, None] + model.bias
            lang, score = _decide(model, margins, counts > 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names, *into]
            )

    rest = docs.drop(*into)
    return rest.mapInArrow(run, plus(rest, f"`{into[0]}` string, `{into[1]}` double"))
