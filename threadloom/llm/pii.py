"""Personal data: patterns propose spans, check digits confirm them, nearby words move the score.

Base kinds are fixed patterns with fixed checks and always stay. Further proposals (account
numbers by mod 97, local telephone and social security numbers, card numbers inside longer
runs of digits) get a score from how telling their form is; words near the span that name the
kind raise it, words that name something else lower it, and spans below the threshold go.
Every pattern is tried in time linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import fresh, plus, steps

THRESHOLD = 0.5
#: Code points before and behind a span in which words are looked at.
BEFORE, BEHIND = 48, 24
RAISE, LOWER = 0.3, 0.3


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


class Kind(NamedTuple):
    name: str
    base: bool
    #: Score of a span that its check confirms.
    score: float
    #: Matches of the pattern that pass the check, in order and apart.
    propose: Callable[[str], Iterator[tuple[int, int]]]
    #: Words that name the kind.
    words: frozenset[str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if not k & 1 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064 mod 97-10 of an account number whose first four characters go to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# The patterns of the base kinds.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A match from inside a run of digits would have matched from its start.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (16, 19), (8, 15), 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the whole run of its characters before the sign, back to the match before."""
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last:
            piece = text[max(last, start - 256) : start]
            rest = len(piece.rstrip(LOCAL))
            start -= len(piece) - rest
            if rest:
                break
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= LARGEST_PART for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
                yield m.span()


# Lengths of international bank account numbers by country.
ACCOUNT_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24,
    "SE": 24, "SI": 19, "SK": 24, "TR": 26, "UA": 29, "AE": 23,
}
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SOCIAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
PLAIN_CARD = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    for m in ACCOUNT.finditer(text):
        want, seen = ACCOUNT_LENGTHS.get(m[0][:2], 0), 0
        for k, c in enumerate(m[0]):
            seen += c != " "
            if seen == want:
                whole = m.end() == m.start() + k + 1 or m[0][k + 1] == " "
                if whole and mod97(m[0][: k + 1].replace(" ", "")):
                    yield m.start(), m.start() + k + 1
                break


def _socials(text: str) -> Iterator[tuple[int, int]]:
    for m in SOCIAL.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in LOCAL_PHONE.finditer(text))


def _plain_cards(text: str) -> Iterator[tuple[int, int]]:
    for m in PLAIN_CARD.finditer(text):
        if "3" <= m[0][0] <= "6" and luhn(m[0]):
            yield m.span()


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Words near a span that name its kind.
KINDS = (
    Kind("email", True, 0.9, _emails, _words("email mail e-mail mailto contact contacto courriel correo kontakt")),
    Kind("ip", True, 0.7, _addresses, _words("ip ipv4 host server address adresse dirección login serveur servidor")),
    Kind("card", True, 0.8, _cards, _words("card visa mastercard amex credit debit carte tarjeta karte kreditkarte cvv")),
    Kind("phone", True, 0.8, _phones, _words("phone tel tel. telephone call mobile fax cell telefon téléphone teléfono")),
    Kind("iban", False, 0.8, _accounts, _words("iban account bank konto compte cuenta bic")),
    Kind("ssn", False, 0.3, _socials, _words("ssn social security insurance")),
    Kind("local_phone", False, 0.3, _local_phones, _words("phone tel tel. telephone call mobile fax cell telefon téléphone teléfono")),
    Kind("plain_card", False, 0.3, _plain_cards, _words("card visa mastercard amex credit debit carte tarjeta karte kreditkarte cvv")),
)
BASE = tuple(kind.name for kind in KINDS if kind.base)
# Words near a span of digits that say it is something else.
OTHER = _words("order invoice isbn issn version build part serial ticket tracking sku model bestellung rechnung commande factura")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*\.?")


def _near(text: str, start: int, end: int) -> set[str]:
    words = _WORD.findall(text[max(0, start - BEFORE) : start]) + _WORD.findall(text[end : end + BEHIND])
    return {w.lower() for w in words}


def spans_of(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """The spans of a text by kind, then start, in code points; those that are not base ones lie apart from all before."""
    found: list[Span] = []
    if "@" not in text and not any(c in text for c in "0123456789"):
        return found
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        if not kind.base and not taken:
            taken = _united(found)
        for start, end in kind.propose(text):
            at = bisect(taken, (end,)) if not kind.base else 0
            if at and taken[at - 1][1] > start:
                continue
            near = _near(text, start, end)
            score = kind.score + RAISE * bool(near & kind.words) - LOWER * bool(near & OTHER)
            score = min(1.0, max(0.0, score))
            if kind.base or score >= threshold:
                found.append(Span(kind.name, start, end, round(score, 6), kind.base))
                if not kind.base:
                    taken.insert(at, (start, end))
    return found


def _united(spans: list[Span]) -> list[tuple[int, int]]:
    """The intervals that the spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s.start, s.end) for s in spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by the kind of its first span in angle brackets."""
    first = {}
    for s in reversed(spans):
        first[s.start] = s.kind
    parts, at = [], 0
    for start, end in _united(spans):
        parts += [text[at:start], f"<{first[start]}>"]
        at = end
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind: string, start: int, end: int, score: double, base: boolean>>"
_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)


def find(
    docs: DataFrame, text_col: str = "text", into: str = "pii", mask_into: str | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """docs with a column of spans (kind, start, end, score, base), never null; every row stays.

    Null and empty texts have none. start and end are code points, end exclusive. With mask_into,
    a column of that name has the text with its spans replaced by their kinds (null for null).
    Columns of the given names are replaced; all others stay as they are. Rows are judged one by
    one, so repeated rows and ids give repeated results; texts of any length are read whole.
    """
    new = (into, mask_into) if mask_into else (into,)
    text, *made = fresh(docs, "text", *new)
    rows = docs.withColumn(text, F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [spans_of(t or "", threshold) for t in texts]
            out = [pa.array([[s._asdict() for s in spans] for spans in found], _SPANS)]
            if mask_into:
                out.append(pa.array([t and masked(t, spans) for t, spans in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*batch.schema.names[:-1], *made])

    types = ", ".join([f"`{made[0]}` {SPANS}", *(f"`{m}` string" for m in made[1:])])
    judged = rows.mapInArrow(run, plus(docs, types))
    kept = [F.col(c) for c in docs.columns if c.lower() not in {n.lower() for n in new}]
    return judged.select(*kept, *(F.col(m).alias(n) for m, n in zip(made, new, strict=True)))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
