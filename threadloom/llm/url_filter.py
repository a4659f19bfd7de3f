"""URL verdicts: host and path rules, else two character language models.

The models are variable-order Markov chains over bytes with Dirichlet back-off from order 5
to 0, one counted on URLs that the rules allow and one on those they block. A context of up to
five bytes, its order and the byte behind it fit a long, so the counts are exact, and a table
that grows with the URLs. URLs are dealt to chunks; every chunk asks for the counts of its
distinct contexts in a join, and its URLs are scored beside what comes back. The threshold on the
difference of log-likelihoods per byte is the one of least balanced error on a calibration
fold that is not counted.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import plus, steps, stored, texts_of

ORDER = 5
STRENGTH = 4.0
PAD = b"\x02" * ORDER
CALIBRATION_FOLDS = 5
BINS = 2000
#: URLs and bytes of URLs that a chunk takes; a longer URL is a chunk of its own.
CHUNK_ROWS, CHUNK_BYTES = 4096, 1 << 19
#: In the place of the byte behind a context, for the count of the context itself.
ANY = 256

ALLOW, BLOCK = "allow", "block"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits.

    A rule (verdict, ``host/path``) fits its host and all subdomains if the path starts with its path.
    """
    name = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _keys(urls: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """URL index of every byte, and per order the keys of its context and of context and byte."""
    data = np.frombuffer(b"".join(PAD + u for u in urls), dtype=np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, urls), dtype=np.int64, count=len(urls))
    owner = np.repeat(np.arange(len(urls)), lengths)
    at = np.arange(len(owner)) + ORDER * (owner + 1)
    keys = []
    context = np.zeros(len(at), dtype=np.int64)
    for k in range(ORDER + 1):
        if k:
            context |= data[at - k] << (8 * (k - 1))
        tagged = (context << 3 | k) << 9
        keys.append((tagged | ANY, tagged | data[at]))
    return owner, keys


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text", 1 << 20):
        blocked = batch.column("blocked").to_numpy(zero_copy_only=False)
        owner, keys = _keys(texts_of(batch, "text"))
        flat = np.concatenate([k for pair in keys for k in pair])
        side = np.tile(blocked[owner], 2 * len(keys))
        key, place = np.unique(flat, return_inverse=True)
        counts = [np.bincount(place[side == kind], minlength=len(key)) for kind in (False, True)]
        yield pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, counts)], names=["key", "accepted", "rejected"])


def train(known: DataFrame) -> DataFrame:
    """Exact counts (key, accepted, rejected) of URLs (text, blocked)."""
    counts = known.mapInArrow(_counted, "key long, accepted long, rejected long")
    return stored(counts.groupBy("key").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "counts")


def _chunked(text: str):
    """Adds the number of a chunk, unlike all others of any task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows, size = (TaskContext.get().partitionId() << 33), 0, 0
        for batch in batches:
            chunks = np.empty(batch.num_rows, dtype=np.int64)
            lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text)).cast(pa.binary())), 0).to_pylist()
            for k, length in enumerate(lengths):
                if rows and (rows == CHUNK_ROWS or size + length > CHUNK_BYTES):
                    chunk, rows, size = chunk + 1, 0, 0
                chunks[k], rows, size = chunk, rows + 1, size + length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks)], names=[*batch.schema.names, "chunk"])

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (chunk, text) to the distinct (chunk, key); a chunk in several batches may ask twice."""
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        urls = texts_of(batch, "text")
        for chunk in np.unique(chunks):
            _, keys = _keys([urls[k] for k in np.flatnonzero(chunks == chunk)])
            key = np.unique(np.concatenate([k for pair in keys for k in pair]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), chunk)), pa.array(key)], names=["chunk", "key"])


def _difference(urls: list[bytes], key: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Log-likelihood per byte, rejected minus accepted, from counts by ascending key; 0 for an empty text."""
    owner, keys = _keys(urls)
    p = [np.full(len(owner), 1 / 256), np.full(len(owner), 1 / 256)]
    for pair in keys:
        places = []
        for wanted in pair:
            at = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
            places.append((at, (key[at] == wanted) if len(key) else np.zeros(len(wanted), dtype=bool)))
        for side, count in enumerate(counts):
            seen, both = (np.where(hit, count[at], 0) if len(key) else np.zeros(len(hit)) for at, hit in places)
            p[side] = (both + STRENGTH * p[side]) / (seen + STRENGTH)
    sums = np.bincount(owner, weights=np.log(p[1]) - np.log(p[0]), minlength=len(urls))
    return sums / np.maximum(np.fromiter(map(len, urls), dtype=np.int64, count=len(urls)), 1)


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    key = counts.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    sides = tuple(counts.column(c).to_numpy()[order].astype(float) for c in ("accepted", "rejected"))
    urls = [x or b"" for x in rows.column("text").cast(pa.binary()).to_pylist()]
    scores = _difference(urls, key[order], sides)
    return rows.drop_columns(["chunk"]).append_column("score", pa.array(scores))


def score(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """rows with a column score for their column text; they have no columns chunk, key or score."""
    dealt = stored(rows.mapInArrow(_chunked("text"), plus(rows, "chunk long")), "chunks")
    asked = dealt.select("chunk", "text").mapInArrow(_asked, "chunk long, key long").distinct()
    answers = asked.join(counts, "key").groupBy("chunk")
    return dealt.groupBy("chunk").cogroup(answers).applyInArrow(_scored, plus(rows, "score double"))


def threshold(scored: DataFrame) -> float:
    """Score of least balanced error on labelled rows (blocked, score), from a fixed histogram; 0 if a class is missing."""
    low, high = -8.0, 8.0
    place = F.floor((F.least(F.greatest("score", F.lit(low)), F.lit(high - 1e-9)) - low) / ((high - low) / BINS)).cast("int")
    counts = np.zeros((2, BINS))
    for row in scored.groupBy("blocked", place.alias("bin")).count().collect():  # at most 2 * BINS rows
        counts[int(row["blocked"]), row["bin"]] = row["count"]
    if not counts.sum(axis=1).all():
        return 0.0
    accepted, rejected = counts / counts.sum(axis=1, keepdims=True)
    wrong = np.r_[np.cumsum(accepted[::-1])[::-1], 0] + np.r_[0, np.cumsum(rejected)]
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(low + (high - low) / BINS * (best[0] + best[-1]) / 2)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (id, host, path, rule, verdict, score, decided_by), one per row of pages.

    verdict is that of the longest fitting rule, else block if score (rejected minus accepted
    log-likelihood per byte after ``://``) exceeds the calibrated threshold. Null, empty and
    malformed URLs score 0 and, with no rule and nothing to read, are allowed.
    """
    url = F.col(url_col)
    host, path = parts(url)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), url.alias("url"))
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rows = rows.select("id", "host", "path", rule.alias("rule"), kind.alias("kind"), after.alias("text"))
    known = rows.where("rule is not null").select("text", (F.col("kind") == BLOCK).alias("blocked"))
    held_out = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_FOLDS)) == 0
    scored = stored(score(rows.withColumn("held_out", held_out), train(known.where(~held_out))), "scored")
    fold = scored.where(F.col("rule").isNotNull() & F.col("held_out")).select((F.col("kind") == BLOCK).alias("blocked"), "score")
    cut = threshold(fold)
    asked = F.when(F.col("text") == "", ALLOW).when(F.col("score") > cut, BLOCK).otherwise(ALLOW)
    return scored.select(
        "id",
        "host",
        "path",
        "rule",
        F.coalesce("kind", asked).alias("verdict"),
        "score",
        F.when(F.col("rule").isNull(), "model").otherwise("rule").alias("decided_by"),
    )
