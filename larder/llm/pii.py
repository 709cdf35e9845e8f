"""Personal data: patterns propose spans, checksums confirm them, words nearby set the score.

Base kinds are email, ip, card and phone. The method adds iban (mod-97) and national, a
phone number without country code that only counts next to a word such as "tel".
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType,
)

from larder.llm.common import with_struct

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national")
# Words that make a kind likelier, and those that speak against it.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("tel", "phone", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "national": ("tel", "phone", "call", "mobile", "fax"),
}
AGAINST = ("example", "version", "order", "invoice")
CONTEXT_CHARS = 40
START_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.9, "national": 0.3}
CONTEXT_STEP = 0.3
ACCEPT = 0.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9+A-Za-z])0[0-9]{2,4}[ /-][0-9]{3,4}[ -]?[0-9]{2,4}(?![0-9A-Za-z])")
_WORD = re.compile(r"[a-z]+")

SPAN = StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("base", BooleanType()), StructField("score", DoubleType()),
])
RESULT = StructType([StructField("spans", ArrayType(SPAN))])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    """Around each @: the run of name characters before it and the domain after it."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            low = domain.end()
        else:
            low = at + 1
        at = text.find("@", low)


def _ips(text: str):
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        code = m.group().replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield m.span()


def _nationals(text: str):
    for m in _NATIONAL.finditer(text):
        if 8 <= sum(map(str.isdigit, m.group())) <= 12:
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "national": _nationals}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = set(_WORD.findall(text[max(0, start - CONTEXT_CHARS) : start].lower()))
    near.update(_WORD.findall(text[end : end + CONTEXT_CHARS].lower()))
    score = START_SCORE[kind] + CONTEXT_STEP * (not near.isdisjoint(CONTEXT[kind]))
    score -= CONTEXT_STEP * (not near.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, score)), 3)


def find(text: str | None) -> list[dict]:
    """Spans in code points, end exclusive, by start and then kind.

    Base spans always stay; a span the method adds needs a score of ACCEPT and must not
    overlap a base span.
    """
    text = text or ""
    spans = []
    for rank, kind in enumerate(KINDS):
        base = kind in BASE
        for start, end in _FINDERS[kind](text):
            score = _score(text, kind, start, end)
            if base or score >= ACCEPT and not any(s[0] < end and start < s[3] for s in spans):
                spans.append((start, rank, kind, end, base, score))
    return [{"kind": k, "start": s, "end": e, "base": b, "score": c} for s, _, k, e, b, c in sorted(spans)]


def find_spans(
    df: DataFrame, text: str = "text", into: str = "pii", keep: list[str] | None = None
) -> DataFrame:
    """Adds the struct ``into`` with spans: array of kind, start, end, base, score.

    Null and empty texts have none. Rows, also repeated ones, and other columns stay as
    they are (``keep`` names fewer columns); an existing column ``into`` is replaced.
    """
    return with_struct(df, [text], into, RESULT, lambda: lambda texts: [{"spans": find(t)} for t in texts], keep)


def spans_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(df: DataFrame, text: str = "text", length: str | None = "n_chars", least: float = 0.0) -> DataFrame:
    """The texts with every span of at least ``least`` replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first. Null texts stay
    null; ``length``, if it exists, is set to the new number of code points.
    """
    def masked(texts: list) -> list[dict]:
        out = []
        for t in texts:
            pieces, at = [], 0
            for s in find(t):
                if s["score"] < least:
                    continue
                if s["start"] >= at:
                    pieces += [t[at : s["start"]], f"<{s['kind']}>"]
                at = max(at, s["end"])
            out.append({"text": t if t is None or not pieces else "".join(pieces) + t[at:]})
        return out

    done = with_struct(df, [text], "_masked", StructType([StructField("text", StringType())]), lambda: masked)
    columns = []
    for c in df.columns:
        if c == text:
            columns.append(F.col("_masked.text").alias(c))
        elif c == length:
            columns.append(F.length("_masked.text").cast(df.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return done.select(*columns)
