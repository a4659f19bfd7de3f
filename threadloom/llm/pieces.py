"""SentencePiece BPE with seeded merge dropout, and its decoding.

The vocabulary is that of a given model file; nothing is trained. A text is cut into words (a
run of spaces with what follows it), which no piece crosses. In each word the agenda holds the
candidate merges of neighbouring symbols by score, then place. A candidate is dropped when the
hash of (seed, id, place of its left symbol, merged piece) falls below the dropout rate, so the
same seed and id give the same segmentation on any executor, and another seed another one.
Characters without a piece become byte pieces, the space symbol itself included, so decoding
gives back every text.

Words are handled together: one array step takes the best candidate of every unfinished
word. Words of very many symbols go through a heap instead, with the same result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import fresh, mix, plus, steps

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 42
LONG_WORD = 96
#: Characters that one array step takes; longer texts are cut where words begin.
STEP = 1 << 18
SPACE = "▁"
NONE = np.int32(np.iinfo(np.int32).max)
TABLE_BITS = 20


class Pieces:
    """Tables of a BPE model with byte fallback."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        ids = {name: i for i, (name, s) in enumerate(zip(names, special, strict=True)) if not s}
        if any(SPACE in name.lstrip(SPACE) for name in ids):
            raise ValueError("a piece of this model reaches over a word's end")
        self.bytes_of = [name.replace(SPACE, " ").encode() if name in ids else b"" for name in names]
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in range(n):
            if model.is_byte(i):
                value = int(names[i][3:-1], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
        if not self.byte_ids.all():
            raise ValueError("this model has no byte pieces for characters outside its vocabulary")
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        self.space = int(self.symbol[ord(SPACE)])
        self.symbol[0x20], self.symbol[ord(SPACE)] = self.space, -1
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        pairs = {
            (ids[name[:k]], ids[name[k:]]): i
            for name, i in ids.items()
            for k in range(1, len(name))
            if name[:k] in ids and name[k:] in ids
        }
        keys = np.array([a * n + b for a, b in pairs], dtype=np.int64)
        self.size, self.keys = n, np.full(1 << TABLE_BITS, -1, dtype=np.int64)
        self.made = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
        merged = np.fromiter(pairs.values(), dtype=np.int32, count=len(keys))
        place = self._place(keys)
        while len(keys):  # linear probing, one step for all keys that found their place taken
            free = self.keys[place] < 0
            _, first = np.unique(place, return_index=True)
            own = np.zeros(len(keys), dtype=bool)
            own[first] = True
            own &= free
            self.keys[place[own]], self.made[place[own]] = keys[own], merged[own]
            keys, merged, place = keys[~own], merged[~own], (place[~own] + 1) & ((1 << TABLE_BITS) - 1)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 if none."""
        keys = left.astype(np.int64) * self.size + right
        place = self._place(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.made[place], np.int32(-1))
        on = np.flatnonzero((found != keys) & (found >= 0))
        while len(on):
            place[on] = (place[on] + 1) & ((1 << TABLE_BITS) - 1)
            found = self.keys[place[on]]
            hit = found == keys[on]
            out[on[hit]] = self.made[place[on[hit]]]
            on = on[~hit & (found >= 0)]
        return out


class Encoder:
    def __init__(self, pieces: Pieces, seed: int = SEED, dropout: float = DROPOUT):
        self.pieces = pieces
        self.seed = mix(np.array([seed & ((1 << 64) - 1)], dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))[0]
        self.below = np.uint64(min(dropout, 1.0) * float((1 << 64) - 2048))

    def _dropped(self, place: np.ndarray, merged: np.ndarray) -> np.ndarray:
        return mix(place + merged.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) < self.below

    def _ranks(self, left, right, place) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of candidate merges; NONE for no candidate or a dropped one."""
        merged = self.pieces.merge(left, right)
        rank = np.full(len(merged), NONE)
        on = np.flatnonzero(merged >= 0)
        kept = on[~self._dropped(place[on], merged[on])] if self.below else on
        rank[kept] = self.pieces.rank[merged[kept]]
        return merged, rank

    def _by_heap(self, symbols: list[int], places: np.ndarray) -> list[tuple[int, int]]:
        """The agenda for one long word: (index of first symbol, piece) of the result."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        version, agenda = [0] * n, []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                merged, rank = self._ranks(
                    np.array([symbols[i]], dtype=np.int32), np.array([symbols[after[i]]], dtype=np.int32), places[i : i + 1]
                )
                if rank[0] != NONE:
                    heapq.heappush(agenda, (int(rank[0]), i, version[i], after[i], version[after[i]], int(merged[0])))

        for i in range(n):
            offer(i)
        while agenda:
            _, i, v, j, w, merged = heapq.heappop(agenda)
            if version[i] != v or version[j] != w or after[i] != j:
                continue
            symbols[i], version[i], version[j] = merged, v + 1, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append((i, symbols[i]))
            i = after[i]
        return out

    def __call__(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin and end; keys are 64-bit ids."""
        return self.parts([" " + t if t else "" for t in texts], keys, np.zeros(len(texts), dtype=np.int64))

    def parts(self, texts: list[str], keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As for whole texts, for parts of them as cut by _cut, which begin at the given places of their texts."""
        p = self.pieces
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(texts)), lengths)
        begins = np.cumsum(lengths) - lengths
        inner = np.arange(len(codes)) - (begins - places)[owner]
        place_of = mix(mix(keys.view(np.uint64) ^ self.seed)[owner] + inner.astype(np.uint64))
        symbols = p.symbol[codes]
        final = np.full(len(codes), -1, dtype=np.int32)
        at = np.flatnonzero(symbols >= 0)
        if len(at):
            s = symbols[at]
            start = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]) | ((s[1:] == p.space) & (s[:-1] != p.space))]
            first = np.flatnonzero(start)
            sizes = np.diff(np.r_[first, len(at)])
            for f, size in zip(first[sizes > LONG_WORD], sizes[sizes > LONG_WORD], strict=True):
                for k, piece in self._by_heap(s[f : f + size].tolist(), place_of[at[f : f + size]]):
                    final[at[f + k]] = piece
            short = np.repeat(sizes <= LONG_WORD, sizes)
            self._together(at[short], s[short], sizes[sizes <= LONG_WORD], place_of, final)
        return self._with_bytes(codes, symbols, final, owner, len(texts))

    def _together(self, at, s, sizes, place_of, final) -> None:
        """The agenda of all words at once, one merge per word and step; the result goes to final."""
        ends = np.cumsum(sizes)
        rank, merged = np.full(len(s), NONE), np.full(len(s), -1, dtype=np.int32)
        pair = np.ones(len(s), dtype=bool)
        pair[ends - 1] = False
        i = np.flatnonzero(pair)
        merged[i], rank[i] = self._ranks(s[i], s[np.minimum(i + 1, len(s) - 1)], place_of[at[i]])
        while len(sizes):
            best = np.minimum.reduceat(rank, ends - sizes)
            done = best == NONE
            if done.any():
                gone = np.repeat(done, sizes)
                final[at[gone]] = s[gone]
                on = ~gone
                at, s, rank, merged = at[on], s[on], rank[on], merged[on]
                sizes, best = sizes[~done], best[~done]
                ends = np.cumsum(sizes)
                if not len(sizes):
                    return
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            word = np.searchsorted(ends, hit, side="right") if len(hit) > len(sizes) else np.arange(len(sizes))
            left = hit[np.r_[True, word[1:] != word[:-1]]]
            s[left] = merged[left]
            on = np.ones(len(s), dtype=bool)
            on[left + 1] = False
            at, s, rank, merged = at[on], s[on], rank[on], merged[on]
            left = left - np.arange(len(left))
            sizes = sizes - 1
            ends = np.cumsum(sizes)
            begins = ends - sizes
            rank[left] = NONE
            for i in (left[left + 1 < ends], left[left > begins] - 1):
                merged[i], rank[i] = self._ranks(s[i], s[i + 1], place_of[at[i]])

    def _with_bytes(self, codes, symbols, final, owner, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Put in the byte pieces of characters without a symbol."""
        odd = symbols < 0
        counts = (final >= 0).astype(np.int64)
        c = codes[odd]
        counts[odd] = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        starts = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), dtype=np.int32)
        plain = final >= 0
        ids[starts[plain]] = final[plain]
        # UTF-8, most significant byte first.
        where, width = starts[odd], counts[odd]
        for k in range(int(width.max(initial=0))):
            on = width > k
            value = c[on] >> (6 * (width[on] - 1 - k)).astype(np.uint32)
            lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[width[on]]
            byte = np.where(width[on] == 1, value, (lead | value) if k == 0 else 0x80 | (value & 0x3F))
            ids[where[on] + k] = self.pieces.byte_ids[byte]
        per_text = np.bincount(owner, weights=counts, minlength=n).astype(np.int64)
        return ids, np.r_[0, np.cumsum(per_text)]


def _cut(text: str, limit: int) -> list[tuple[int, str]]:
    """A text behind a space in parts of about limit characters that begin where words begin, each with its place."""
    text, parts, at = " " + text if text else "", [], 0
    while len(text) - at > limit:
        to = at + limit
        while (to := text.find(" ", to)) > 0 and text[to - 1] == " ":
            to += 1
        if to < 0:
            break
        parts.append((at, text[at:to]))
        at = to
    return [*parts, (at, text[at:])]


def _joined_steps(parts: list[tuple[int, int, str]], limit: int) -> Iterator[list[tuple[int, int, str]]]:
    """Parts (text, place, part) in lists of about limit characters."""
    some, size = [], 0
    for part in parts:
        if some and size + len(part[2]) > limit:
            yield some
            some, size = [], 0
        some.append(part)
        size += len(part[2])
    if some:
        yield some


def _segment(encoder: Encoder, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of whole texts, however long, in steps of about STEP characters."""
    parts = [(k, place, part) for k, text in enumerate(texts) for place, part in _cut(text, STEP)]
    ids, counts = [], np.zeros(len(texts), dtype=np.int64)
    for some in _joined_steps(parts, STEP):
        owner = np.array([k for k, _, _ in some])
        made, bounds = encoder.parts([part for _, _, part in some], keys[owner], np.array([place for _, place, _ in some]))
        ids.append(made)
        np.add.at(counts, owner, np.diff(bounds))
    return np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), np.r_[0, np.cumsum(counts)]


def _text(known: list[bytes], ids: np.ndarray) -> str:
    """The text of piece ids; the first piece begins with the space that encoding put before the text."""
    return b"".join([known[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


def _proto(model_file: str) -> bytes:
    with open(model_file, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    model_file: str = MODEL,
    seed: int = SEED,
    dropout: float = DROPOUT,
    id_col: str = "doc_id",
    text_col: str = "text",
    verify_into: str | None = None,
) -> DataFrame:
    """docs with piece_ids array<int>: null for null text, empty for empty text.

    With verify_into, a boolean column of that name tells whether the pieces decode to the text; it is
    made in the same step as the pieces. The model file is read on the driver only, and its tables are
    made there and broadcast. Columns of docs named as the new ones are replaced. Rows that share id and
    text get the same pieces; a null id is an id of its own. A text takes memory in proportion to its
    longest word, beside the text itself.
    """
    new = ("piece_ids", *([verify_into] if verify_into else []))
    rest = docs.drop(*new)
    (key,) = fresh(rest, "key")
    rows = rest.withColumn(key, F.xxhash64(F.col(id_col)))
    tables = rest.sparkSession.sparkContext.broadcast(Pieces(_proto(model_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tables.value
        encoder = Encoder(pieces, seed, dropout)
        for batch in steps(batches, text_col, 4 * STEP):
            column = batch.column(batch.schema.get_field_index(text_col))
            texts, none = column.to_pylist(), pc.is_null(column)
            ids, bounds = _segment(encoder, [t or "" for t in texts], batch.column(batch.num_columns - 1).to_numpy())
            out = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids), mask=none)]
            if verify_into:
                spans = zip(texts, bounds[:-1], bounds[1:], strict=True)
                out.append(pa.array([t is None or _text(pieces.bytes_of, ids[a:b]) == t for t, a, b in spans], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*batch.schema.names[:-1], *new])

    types = ["piece_ids array<int>", *([f"`{verify_into}` boolean"] if verify_into else [])]
    return rows.mapInArrow(run, plus(rest, ", ".join(types)))


def decode(rows: DataFrame, model_file: str = MODEL, ids_col: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """rows with the text of ids_col in a column of the given name; null ids give null."""
    proto = rows.sparkSession.sparkContext.broadcast(_proto(model_file))
    rest = rows.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Pieces(proto.value).bytes_of
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = []
            for a, b, valid in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist(), strict=True):
                texts.append(_text(known, values[a:b]) if valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return rest.mapInArrow(run, plus(rest, f"`{into}` string"))
