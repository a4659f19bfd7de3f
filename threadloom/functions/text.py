"""Text functions, Column -> Column.

Everything but entity decoding is a built-in expression and stays in code
generation. ``[^\\n]`` is written out instead of ``.`` because the regex dialects
disagree on which line breaks ``.`` skips, and whitespace is spelled out because
Java's ``\\s`` is ASCII only.
"""

import html
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import defaults

# The ranges of code points that Unicode counts as whitespace.
WHITESPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
# The same as the body of a character class, and as one string.
WHITESPACE_CLASS = "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in WHITESPACE_RANGES)
WHITESPACE_CHARS = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))

# Inline markup as (what a text must contain, pattern). Each match is
# replaced by the text it wraps, in this order.
INLINE_MARKUP = (
    ("**", r"\*\*([^\n]*?)\*\*"),
    ("*", r"\*([^\n]*?)\*"),
    ("~~", r"~~([^\n]*?)~~"),
    ("`", r"`([^\n]*?)`"),
    ("](", r"\[([^\n]*?)\]\([^\n]*?\)"),
)


@F.arrow_udf(T.StringType())
def _decode_entities(texts: pa.Array) -> pa.Array:
    return pa.array(
        [None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string()
    )


def html_unescape(text: Column) -> Column:
    """Decode HTML entities once. The text of rows without any does not cross to Python."""
    has_entity = text.contains("&") & text.rlike("&[#A-Za-z]")
    return F.coalesce(_decode_entities(F.when(has_entity, text)), text)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` knows U+0020 only)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def replace_where(text: Column, marker: str, pattern: str, replacement: str) -> Column:
    """Replace a pattern in the texts that contain ``marker``; a byte search spares the
    others the pattern. ``text`` is evaluated more than once, so pass a plain column."""
    replaced = F.regexp_replace(text, pattern, replacement)
    return F.when(text.contains(marker), replaced).otherwise(text)


def markup_steps() -> list[Callable[[Column], Column]]:
    """The cleaning steps between entity decoding and the final strip, in order."""

    def unwrap(marker: str, pattern: str) -> Callable[[Column], Column]:
        return lambda text: replace_where(text, marker, pattern, "$1")

    return [
        *[unwrap(marker, pattern) for marker, pattern in INLINE_MARKUP],
        drop_urls,
        one_line,
        squeeze_spaces,
    ]


def drop_urls(text: Column) -> Column:
    return replace_where(text, "http", f"http[^{WHITESPACE_CLASS}]+", "")


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def squeeze_spaces(text: Column) -> Column:
    """Runs of spaces become one; other whitespace stays."""
    return replace_where(text, "  ", " {2,}", " ")


def clean_text(text: Column) -> Column:
    """Plain text of a post or comment body; null becomes ''.

    For an expression inside another; :func:`threadloom.operators.cleaning.with_clean_text`
    is faster for a column of a frame.
    """
    plain = html_unescape(F.coalesce(text, F.lit("")))
    for _, pattern in INLINE_MARKUP:
        plain = F.regexp_replace(plain, pattern, "$1")
    plain = F.regexp_replace(plain, f"http[^{WHITESPACE_CLASS}]+", "")
    return strip(F.regexp_replace(one_line(plain), " {2,}", " "))


def stripped_length(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit(""))))


def preview(text: Column, chars: int = 50) -> Column:
    """First characters of a title, for a progress report; missing becomes ''."""
    return F.substring(F.coalesce(text, F.lit("")), 1, chars)


def is_low_quality(text: Column, min_chars: int = defaults.MIN_POST_CHARS) -> Column:
    """True for posts without enough text, deleted ones and removed ones."""
    stripped = strip(F.coalesce(text, F.lit("")))
    too_short = F.length(stripped) < min_chars
    if min_chars > max(map(len, defaults.REMOVED_MARKERS)):
        return too_short  # the markers are too short as well
    return stripped.isin(*defaults.REMOVED_MARKERS, "") | too_short


def is_removed(text: Column) -> Column:
    """True for empty, deleted or removed comments."""
    return strip(F.coalesce(text, F.lit(""))).isin(*defaults.REMOVED_MARKERS, "")


def is_non_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def join_title_body(title: Column, body: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))


def split_list(csv: Column) -> Column:
    """'a, b,,c' -> ['a', 'b', 'c']; blank or null -> []."""
    items = F.transform(F.split(F.coalesce(csv, F.lit("")), ","), strip)
    return F.filter(items, lambda item: item != "")


def contains_term(text: Column, term: str) -> Column:
    return F.lower(text).contains(term.lower())


def contains_any_word(text: Column, words: list[str]) -> Column:
    """True if any whitespace-separated word of the text is in ``words``, ignoring case."""
    tokens = F.split(F.lower(text), f"[{WHITESPACE_CLASS}]+")
    return F.arrays_overlap(tokens, F.array(*[F.lit(w.lower()) for w in words]))
