"""Removal of word passages that also start in an earlier document.

A window is 13 consecutive words. Its key for counting is its minimizer, the smallest hash
among its seven-word parts: equal windows have equal minimizers, so minimizer counts never
fall below window counts. Pass one counts minimizers in count-min sketches, one per
partition, merged by slices on the executors; what reaches the driver is one bit per slot,
"estimated at two or more", of a size fixed by a parameter. Pass two sends only windows
whose minimizer has that bit in both rows to an exact grouping by a 96-bit window hash; no
repeated window is lost, and the size of the sketch changes only how many others go along.
Within an Arrow batch, every document but the smallest with a window is decided at once, so
a very frequent window reaches the grouping once per batch, not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import Rolling, mix, steps, texts_of

WINDOW = 13
PART = 7
#: Slots of a sketch row: at least eight per expected minimizer, at most 2**28 (a broadcast of 2 * 32 MB).
MIN_SLOT_BITS, MAX_SLOT_BITS = 20, 28
SLICES = 256
ROWS = 2
PIECE = 1 << 22

_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Windows:
    """Windows of a list of texts: document index, position, 96-bit hash and minimizer."""

    def __init__(self):
        self.bytes, self.words = Rolling(0x5851F42D4C957F2D), Rolling(0xD1342543DE82EF95)
        self.more = Rolling(0x2545F4914F6CDD1D)

    def word_hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word and the index of its text."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.r_[0, edge]
        starts, ends = edge[0::2], edge[1::2]
        starts = starts[: len(ends)]
        hashes = np.zeros(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):  # in pieces, so the tables of powers stay small
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, side="right")))
            low, high = starts[at], ends[to - 1]
            hashes[at:to] = self.bytes(_BYTE_CODES[data[low:high]], starts[at:to] - low, ends[at:to] - low)
            at = to
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(np.cumsum(lengths), starts, side="right")

    def __call__(self, texts: list[bytes]):
        hashes, doc = self.word_hashes(texts)
        first = np.searchsorted(doc, np.arange(len(texts)), side="left")
        at = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1 :]) if len(doc) >= WINDOW else np.zeros(0, dtype=np.int64)
        h1 = np.zeros(len(at), dtype=np.uint64)
        h2 = np.zeros(len(at), dtype=np.uint64)
        key = np.zeros(len(at), dtype=np.uint64)
        done = 0
        while done < len(at):
            part = at[done : done + PIECE]
            low, high = part[0], part[-1] + WINDOW
            own, s = hashes[low:high], part - low
            h1[done : done + PIECE] = mix(self.words(own, s, s + WINDOW))
            h2[done : done + PIECE] = self.more(own, s, s + WINDOW) >> np.uint64(33)
            p = np.arange(len(own) - PART + 1)
            parts = mix(self.words(own, p, p + PART))
            least = parts[s]
            for k in range(1, WINDOW - PART + 1):
                np.minimum(least, parts[s + k], out=least)
            key[done : done + PIECE] = least
            done += PIECE
        d = doc[at]
        return d, at - first[d], h1, h2, key


def _slots(key: np.ndarray, bits: int) -> list[np.ndarray]:
    """One slot of each sketch row per key."""
    other = mix(key ^ np.uint64(0xA0761D6478BD642F))
    return [(k >> np.uint64(64 - bits)).astype(np.int64) + (row << bits) for row, k in enumerate((mix(key), other))]


def _partition_sketch(bits: int):
    width = (ROWS << bits) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows()

        def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
            slots, counts = np.unique(np.concatenate(parts), return_counts=True)
            which, data, twice = [], [], []
            cuts = np.searchsorted(slots, np.arange(SLICES + 1) * width)
            for k in range(SLICES):
                own, n = slots[cuts[k] : cuts[k + 1]] - k * width, counts[cuts[k] : cuts[k + 1]]
                if len(own):
                    which.append(k)
                    data.append(_pack(own))
                    twice.append(_pack(own[n > 1]))
            return pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int32()), pa.array(data, pa.binary()), pa.array(twice, pa.binary())],
                names=["slice", "once", "twice"],
            )

        held, n = [], 0
        for batch in steps(batches, "text"):
            doc, _, _, _, key = windows(texts_of(batch, "text"))
            if not len(key):
                continue
            # Neighbouring windows of a text mostly share one minimizer.
            own = key[np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]]
            held += _slots(own, bits)
            n += ROWS * len(own)
            if n > PIECE:
                yield emit(held)
                held, n = [], 0
        if held:
            yield emit(held)

    return run


def _pack(slots: np.ndarray) -> bytes:
    """Sorted slot numbers as differences, byte planes apart so that zeros compress."""
    steps = np.diff(slots, prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(planes.T.copy().view("<u4").ravel().astype(np.int64))


def _merged(bits: int):
    """Adds up the sketches of a slice as they arrive; one bit per slot comes out."""
    width = (ROWS << bits) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, None

        def out() -> pa.RecordBatch:
            packed = np.packbits(counts > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], names=["slice", "bits"])

        for batch in batches:
            for which, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if which != now:
                    if now is not None:
                        yield out()
                    now, counts = which, np.zeros(width, dtype=np.uint8)
                for slots in (_unpack(once), _unpack(twice)):
                    counts[slots] = np.minimum(counts[slots] + 1, 2)
        if now is not None:
            yield out()

    return run


def repeated_slots(docs: DataFrame, slot_bits: int | None = None) -> tuple[np.ndarray, int]:
    """The bits of slots estimated at two or more, of both sketch rows, and the slots' bit number.

    Its size is (2 << slot_bits) / 8 bytes: 64 MB at most, however much text there is.
    """
    if slot_bits is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # A minimizer for about every 20 bytes, eight slots for each.
        slot_bits = min(MAX_SLOT_BITS, max(MIN_SLOT_BITS, int(size * 8 / 20).bit_length()))
    slot_bits = max(slot_bits, 10)  # whole bytes of bits per slice
    merged = (
        docs.select("text")
        .mapInArrow(_partition_sketch(slot_bits), "slice int, once binary, twice binary")
        .repartition("slice")
        .sortWithinPartitions("slice")
        .mapInArrow(_merged(slot_bits), "slice int, bits binary")
    )
    width = (ROWS << slot_bits) // SLICES
    bits = np.zeros((ROWS << slot_bits) // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():
        bits[row["slice"] * width // 8 : (row["slice"] + 1) * width // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits, slot_bits


CANDIDATES = "h1 long, h2 int, id long, tag int, pos int, done binary"


def _candidates(shared, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, flags = Windows(), shared.value
        for batch in steps(batches, "text"):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            doc, pos, h1, h2, key = windows(texts_of(batch, "text"))
            keep = np.ones(len(key), dtype=bool)
            for slots in _slots(key, bits):
                keep &= (flags[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
            doc, pos, h1, h2 = doc[keep], pos[keep].astype(np.int32), h1[keep].view(np.int64), h2[keep].astype(np.int32)
            order = np.lexsort((pos, ids[doc], h2, h1))
            doc, pos, h1, h2 = doc[order], pos[order], h1[order], h2[order]
            own = ids[doc]
            lead = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else np.zeros(0, dtype=bool)
            least = own[np.flatnonzero(lead)][np.cumsum(lead) - 1] if len(h1) else own
            done = own > least
            open_ = ~done
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[open_]), pa.array(h2[open_]), pa.array(own[open_]), pa.array(tags[doc[open_]]), pa.array(pos[open_]), pa.nulls(int(open_.sum()), pa.binary())],
                names=["h1", "h2", "id", "tag", "pos", "done"],
            )
            found, where = doc[done], pos[done]
            order = np.lexsort((where, found))
            found, where = found[order], where[order]
            docs, starts = np.unique(found, return_index=True)
            packed = [_pack(x.astype(np.int64)) for x in np.split(where, starts[1:])] if len(docs) else []
            none = pa.nulls(len(docs), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[docs]), none, pa.array(ids[docs]), pa.array(tags[docs]), none, pa.array(packed, pa.binary())],
                names=["h1", "h2", "id", "tag", "pos", "done"],
            )

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of window and id: those of every id but a window's smallest."""
    last = (None, None, None)
    for batch in batches:
        packed = batch.column(5)
        passed = packed.is_valid()
        told = batch.filter(passed)
        if told.num_rows:
            yield told.select(["id", "tag", "pos", "done"])
        rest = batch.filter(pa.compute.invert(passed))
        if not rest.num_rows:
            continue
        h1, h2, own = (rest.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        lead = np.r_[(h1[0], h2[0]) != last[:2], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        heads = np.flatnonzero(lead)
        group = np.cumsum(lead) - 1
        least = np.where(group < 0, last[2] if last[2] is not None else own[0], own[heads][group] if len(heads) else own)
        last = (h1[-1], h2[-1], least[-1])
        later = rest.filter(pa.array(own > least))
        if later.num_rows:
            yield later.select(["id", "tag", "pos", "done"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        out = ([], [], [], [])
        rows = zip(texts_of(batch, "text"), batch.column("pos").to_pylist(), batch.column("done").to_pylist(), strict=True)
        for text, pos, done in rows:
            words = text.split()
            gone = np.zeros(len(words) + 1, dtype=np.int32)
            for starts in ([np.array(pos, dtype=np.int64)] if pos else []) + [_unpack(x) for x in done or []]:
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + WINDOW, -1)
            drop = np.cumsum(gone[:-1]) > 0
            removed = int(drop.sum())
            left = b" ".join([w for w, d in zip(words, drop.tolist(), strict=True) if not d] if removed else words)
            for column, value in zip(out, (len(words), removed, hashlib.sha256(left).hexdigest(), left.decode()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())],
            names=["id", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slot_bits: int | None = None) -> DataFrame:
    """Rows (id, n_words, n_removed, kept_sha256, kept): one per row of docs.

    Words are separated by ASCII white space and kept unchanged. A word goes if a window of 13
    words covers it whose word sequence also starts in a document with a smaller id. Null text
    has no words; texts of under 13 words keep all. Rows that share an id are never earlier than
    one another; rows with a null id keep all words and count as no one's earlier document.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.hash(F.col(text_col)).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    named = rows.where("id is not null")
    flags, bits = repeated_slots(named, slot_bits)
    shared = spark.sparkContext.broadcast(flags)
    hits = (
        named.mapInArrow(_candidates(shared, bits), CANDIDATES)
        .repartition("h1", "h2")
        .sortWithinPartitions("h1", "h2", "id")
        .mapInArrow(_later, "id long, tag int, pos int, done binary")
        .groupBy("id", "tag")
        .agg(F.collect_list("pos").alias("pos"), F.collect_list("done").alias("done"))
    )
    return rows.join(hits, ["id", "tag"], "left").select("id", "text", "pos", "done").mapInArrow(
        _kept, "id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
