"""Benchmark items in documents, also with other numbers, names and units.

Words become template tokens: numbers, names (runs of capitalised words) and units after a
number turn into typed placeholders, other words are lower-cased without outer punctuation.
Windows of 13 template tokens are hashed. A bitmap of fixed size, made from the benchmark's
hashes, keeps documents' windows that cannot match at home; the others meet the benchmark's
in a hash join and must agree in every template token. Within a window, a placeholder value of the
item must always stand for the same value in the document; over all windows of one alignment,
most of them must.

Where an item has too few template tokens, or a window of it too few words among them, a template
says too little; there the words themselves are searched, lower-cased, in windows of 13 words or
the whole of what is shorter. Only copies with the same values are found by these.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import Rolling, mix, steps, stored

WINDOW = 13
#: Items of fewer template tokens are one window of their own; shorter ones than this are searched word by word.
SHORTEST = 5
#: Share of a window's tokens that must be words; the others are searched word by word.
MIN_WORDS = 0.5
#: An alignment counts while fewer than this share of its placeholder values are contradicted.
MAX_CONTRADICTED = 0.5
#: The bitmap has 2**25 bits, 4 MB, however large the benchmark is.
BITMAP_BITS = 25
WORDS_KEPT = 300_000
#: Text bytes whose windows one step in Python finds together.
STEP = 1 << 20

LITERAL, NUMBER, NAME, UNIT, NOTHING = range(5)
PLACEHOLDER = {NUMBER: "<number>", NAME: "<name>", UNIT: "<unit>"}

# Units of measure and currencies.
UNITS = frozenset(
    """
    mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
    kilometer kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons
    tonne tonnes pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons cup cups s sec
    second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz
    mhz ghz w kw mw v kv a ma j kj cal kcal pa kpa mph kmh kph c f k b kb mb gb tb bit bits byte bytes
    dollar dollars cent cents euro euros usd eur gbp jpy percent degree degrees
    """.split()
)
_NUMBER = re.compile(r"[+-]?[$€£¥]?\d[\d.,:/]*[%°]?(st|nd|rd|th)?", re.IGNORECASE)
_GLUED = re.compile(r"([+-]?[$€£¥]?\d[\d.,]*)([a-zA-Z]+)")
_OUTER = re.compile(r"^[^\w$€£¥+-]+|[^\w%°]+$")


def _bare(word: str) -> str:
    """The word without outer punctuation."""
    if word.isalpha():
        return word
    if word[-1] in ".,;:!?" and word[:-1].isalpha():
        return word[:-1]
    return _OUTER.sub("", word)


def _kind(word: str) -> tuple[int, str]:
    """Kind of a word by itself and its template form; UNIT is a unit only after a number."""
    bare = _bare(word)
    if not bare.isalpha():
        if not any(c.isalnum() for c in bare):
            return NOTHING, ""
        if _NUMBER.fullmatch(bare):
            return NUMBER, bare
        glued = _GLUED.fullmatch(bare)
        if glued and glued[2].lower() in UNITS:
            return NUMBER, bare
    low = bare if bare.islower() else bare.lower()
    if bare[0].isupper():
        return NAME, bare
    return (UNIT if low in UNITS else LITERAL), low


def _exact(word: str) -> str:
    """The word lower-cased without outer punctuation, or as it is if nothing else is in it."""
    bare = _bare(word)
    return (bare if any(c.isalnum() for c in bare) else word).lower()


class Known(dict):
    """Words numbered as they are met, with kind, hash of the template form and, if asked for, hash of the word itself."""

    def __init__(self, exact: bool):
        self.kinds, self.hashes, self.exact = bytearray(), array("Q"), array("Q") if exact else None

    def __missing__(self, word: str) -> int:
        kind, form = _kind(word)
        # Names and numbers become placeholders whatever they say.
        fixed = kind == LITERAL or kind == UNIT
        self.kinds.append(kind)
        self.hashes.append(h := xxhash.xxh64_intdigest(form.encode()) if fixed else 0)
        if self.exact is not None:
            self.exact.append(h if fixed else xxhash.xxh64_intdigest(_exact(word).encode()))
        self[word] = at = len(self)
        return at


class Tokens(NamedTuple):
    """Template tokens of texts one after another: kind, hash, first word and the one after the last, text."""

    kinds: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray


class Templates:
    """Template tokens of texts, and windows over them; no token and no window crosses texts."""

    def __init__(self, exact: bool):
        self.exact = exact
        self.known = Known(exact)
        self.rolling = Rolling(0x5851F42D4C957F2D)
        slots = {k: xxhash.xxh64_intdigest(v.encode()) for k, v in PLACEHOLDER.items()}
        self.slots = np.array([slots.get(k, 0) for k in range(5)], dtype=np.uint64)

    def codes(self, words: list[str]) -> np.ndarray:
        """Numbers of the words in known, good until the next call."""
        if len(self.known) > WORDS_KEPT:
            self.known = Known(self.exact)
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def word_hashes(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.known.exact, dtype=np.uint64)[codes]

    def tokens(self, codes: np.ndarray, owner: np.ndarray) -> Tokens:
        kinds = np.array(self.known.kinds, dtype=np.uint8)[codes]
        at = np.flatnonzero(kinds != NOTHING)
        kinds, owner = kinds[at], owner[at]
        hashes = np.array(self.known.hashes, dtype=np.uint64)[codes[at]]
        if not len(at):
            return Tokens(kinds, hashes, at, at, owner)
        before = np.r_[np.uint8(LITERAL), kinds[:-1]]
        before[np.r_[True, owner[1:] != owner[:-1]]] = LITERAL
        kinds = np.where((kinds == UNIT) & (before != NUMBER), np.uint8(LITERAL), kinds)
        # A run of names is one name.
        start = ~((kinds == NAME) & (before == NAME))
        first = np.flatnonzero(start)
        ends = np.r_[at[first[1:] - 1] + 1, at[-1] + 1]
        kinds = kinds[first]
        return Tokens(kinds, np.where(kinds == LITERAL, hashes[first], self.slots[kinds]), at[first], ends, owner[first])

    def windows(self, tokens: Tokens, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start token and hash of the windows with enough words."""
        if len(tokens.kinds) < length:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        literal = np.r_[0, np.cumsum(tokens.kinds == LITERAL)]
        enough = literal[length:] - literal[:-length] >= MIN_WORDS * length
        starts = np.flatnonzero(enough & (tokens.owner[length - 1 :] == tokens.owner[: len(tokens.owner) - length + 1]))
        return starts, mix(self.rolling(tokens.hashes, starts, starts + length) + np.uint64(length))

    def word_windows(self, hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows of length words; they differ from those of templates."""
        return mix(self.rolling(hashes, starts, starts + length) - np.uint64(length))


def _spans(tokens: Tokens, starts, length: int) -> dict[int, np.ndarray]:
    """Starts, by length, of the word windows of an item where no window of template tokens is searched."""
    found: dict[int, set[int]] = {}
    kinds, firsts, ends = tokens.kinds, tokens.firsts, tokens.ends
    if length:
        missed = np.setdiff1d(np.arange(len(kinds) - length + 1), starts)
        spans = zip(firsts[missed], ends[missed + length - 1], strict=True)
    else:
        spans = [(firsts[0], ends[-1])] if len(kinds) else []
    for a, b in spans:
        size = min(WINDOW, int(b - a))
        found.setdefault(size, set()).update(range(int(a), int(b) - size + 1))
    return {size: np.array(sorted(at)) for size, at in found.items()}


def _described(words: list[str], tokens: Tokens, start: int, length: int) -> tuple[str, list[str]]:
    """The template of a window and the values of its placeholders, in order."""
    template, values = [], []
    kinds, firsts, ends = tokens.kinds, tokens.firsts, tokens.ends
    for k in range(start, start + length):
        if kinds[k] == LITERAL:
            template.append(_OUTER.sub("", words[firsts[k]]).lower())
        else:
            template.append(PLACEHOLDER[int(kinds[k])])
            values.append(" ".join(_OUTER.sub("", w) for w in words[firsts[k] : ends[k]]).strip())
    return " ".join(template), values


SCHEMA = "h long, id long, start int, word int, length int, template string, vals array<string>"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()))
    columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=["h", "id", "start", "word", "length", "template", "vals"],
    )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From items (id, text) to the windows that stand for them; lengths below zero are of words."""
    templates = Templates(True)
    for batch in steps(batches, "text"):
        found = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = text.split()
            codes = templates.codes(words)
            tokens = templates.tokens(codes, np.zeros(len(words), dtype=np.int64))
            length = min(WINDOW, len(tokens.kinds)) if len(tokens.kinds) >= SHORTEST else 0
            starts, hashes = templates.windows(tokens, length) if length else ((), ())
            for start, h in zip(starts, hashes, strict=True):
                template, values = _described(words, tokens, start, length)
                found.append((int(h.view(np.int64)), key, int(start), int(tokens.firsts[start]), length, template, values))
            for size, places in _spans(tokens, starts, length).items():
                hashes = templates.word_windows(templates.word_hashes(codes), places, size)
                for start, h in zip(places.tolist(), hashes, strict=True):
                    form = " ".join(map(_exact, words[start : start + size]))
                    found.append((int(h.view(np.int64)), key, start, start, -size, form, []))
        yield _rows(found)


def _find(keep, lengths: list[int]):
    """Arrow function from (id, text) to windows; keep tells which hashes stay. The texts of a step go together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(min(lengths, default=0) < 0)
        for batch in steps(batches, "text", STEP):
            keys, words, counts, found = batch.column(0).to_pylist(), [], [], []
            for text in batch.column(1).to_pylist():
                own = text.split()
                counts.append(len(own))
                words += own
            begins = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(counts)), counts)
            codes = templates.codes(words)
            tokens = templates.tokens(codes, owner)
            exact = templates.word_hashes(codes) if templates.exact else None
            token_begins = np.searchsorted(tokens.owner, np.arange(len(counts)))
            for length in lengths:
                if length > 0:
                    starts, hashes = templates.windows(tokens, length)
                    for at in np.flatnonzero(keep(hashes)):
                        start = int(starts[at])
                        k = int(tokens.owner[start])
                        template, values = _described(words, tokens, start, length)
                        place, word = start - int(token_begins[k]), int(tokens.firsts[start] - begins[k])
                        found.append((int(hashes[at].view(np.int64)), keys[k], place, word, length, template, values))
                    continue
                size = -length
                if len(words) < size:
                    continue
                starts = np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1])
                hashes = templates.word_windows(exact, starts, size)
                for at in np.flatnonzero(keep(hashes)):
                    start = int(starts[at])
                    k = int(owner[start])
                    form, place = " ".join(map(_exact, words[start : start + size])), start - int(begins[k])
                    found.append((int(hashes[at].view(np.int64)), keys[k], place, place, length, form, []))
            yield _rows(found)

    return run


def _bitmap(windows: DataFrame) -> np.ndarray:
    """One bit per leading bits of the windows' hashes; each task sends one bitmap, joined as they arrive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
        for batch in batches:
            bits[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["bits"])

    merged = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for row in windows.select("h").mapInArrow(run, "bits binary").toLocalIterator():
        merged |= np.frombuffer(row["bits"], dtype=np.uint8)
    return merged


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Rows (id, item, n_windows, first_word, changed): one per document and item found in it.

    n_windows counts distinct windows of the document; first_word is where the first begins;
    changed tells that no alignment kept all placeholder values as in the benchmark. Null and
    empty texts and rows with null ids match nothing; rows that share an id are one document.
    Items of fewer than five template tokens, and windows with too few words among theirs, are
    searched by their lower-cased words, so with other values they are not found.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    items = items.where("id is not null and text is not null")
    windows = stored(items.mapInArrow(_items, SCHEMA), "benchmark")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most 2 * WINDOW values
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(windows))

    def may_match(h: np.ndarray) -> np.ndarray:
        place = h >> np.uint64(64 - BITMAP_BITS)
        return (shared.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where("id is not null and text is not null")
    own = texts.mapInArrow(_find(may_match, lengths), SCHEMA).alias("d")
    pairs = own.join(windows.alias("b"), ["h", "length", "template"]).select(
        F.col("d.id").alias("id"),
        F.col("b.id").alias("item"),
        F.col("d.word").alias("word"),
        (F.col("d.start") - F.col("b.start")).alias("shift"),
        (F.col("length") < 0).alias("exact"),
        F.arrays_zip(F.col("b.vals").alias("b"), F.col("d.vals").alias("d")).alias("slots"),
    )
    unique = lambda slots: F.size(F.array_distinct(F.transform(slots, lambda s: s["b"])))
    pairs = pairs.where(F.size(F.array_distinct("slots")) == unique(F.col("slots")))
    # The placeholder values of an alignment, once each; an alignment has as many as the item has.
    slots = pairs.select("id", "item", "shift", "exact", "word", F.explode_outer("slots").alias("slot"))
    aligned = slots.groupBy("id", "item", "shift", "exact").agg(
        F.collect_set("slot").alias("slots"), F.collect_set("word").alias("words")
    )
    # Values that stand for several values of the document are in several of the pairs.
    contradicted = F.size("slots") - unique(F.col("slots"))
    same = F.forall("slots", lambda s: s["b"] == s["d"])
    good = aligned.where((F.size("slots") == 0) | (contradicted < MAX_CONTRADICTED * unique(F.col("slots"))))
    return (
        good.select("id", "item", same.alias("same"), F.explode("words").alias("word"))
        .groupBy("id", "item")
        .agg(F.count_distinct("word").alias("n_windows"), F.min("word").alias("first_word"), (~F.bool_or("same")).alias("changed"))
    )
