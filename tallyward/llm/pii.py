"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over the text finds anchors: at-signs, plus signs, digits, URL
schemes and words that announce an identifier. A deterministic parser of the anchor's kind then
expands it to both sides, fixes the boundaries and validates what it found. Nothing else of the text
is looked at, and every parser does work proportional to the characters it takes, so the whole is
linear in the text.

Kinds email, ip, card and phone follow the fixed patterns of `PATTERNS`, leftmost and without
overlaps within a kind; a match that fails its check is dropped and not tried again. Kinds url and
account are added by scheme and cue anchors and never displace the others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

# The patterns the four base kinds must equal, in the order that breaks ties.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = ("url", "account")
KINDS = (*PATTERNS, *ADDED)

SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("account", "acct", "iban", "passport", "ssn", "tax id", "user id", "customer id")

Span = tuple[int, int, str]

_local = re.compile(r"[A-Za-z0-9._%+-]+")
_local_back = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_four_parts = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)").match
_digit_run = re.compile(r"[0-9]+").match
_card_run = re.compile(r"[0-9](?:[\x20-]?[0-9])+").match
_phone_run = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").match
_url_rest = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+").match
_account = re.compile(
    r"(?:[\x20]?(?:no|nr|number|id)\b\.?)?[\x20]{0,2}[:#=]?[\x20]{0,2}"
    r"([A-Za-z]{0,4}[0-9][A-Za-z0-9]*(?:[\x20-][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)",
    re.IGNORECASE | re.ASCII,
).match
_digits_of = re.compile(r"[^0-9]+").sub


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in "@+0123456789":
        found.add_word(sign, (sign if sign in "@+" else "0", 1))
    for word in SCHEMES:
        found.add_word(word, ("url", len(word)))
    for word in CUES:
        found.add_word(word, ("account", len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """The text with ASCII capitals small; every code point stays at its place."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def find(text: str) -> list[Span]:
    """Spans (start, end, kind) in code points, end exclusive, by start and then kind as listed."""
    if not text:
        return []
    spans: list[Span] = []
    ends = dict.fromkeys(KINDS, 0)  # where the search of each kind goes on
    digits_seen = 0  # end of the digit run of the last digit anchor
    for last, (kind, length) in automaton().iter(lowered(text)):
        start = last - length + 1
        if kind == "0":
            if start < digits_seen:
                continue
            digits_seen = _digit_run(text, start).end()
            if start >= ends["ip"] and (m := _four_parts(text, start)):
                ends["ip"] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.groups()):
                    spans.append((start, m.end(), "ip"))
            # inside a digit run that a card match took, the search goes on after that match
            at = max(start, ends["card"])
            if at < digits_seen and (m := _card_run(text, at)):
                ends["card"] = m.end()
                digits = _digits_of("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((at, m.end(), "card"))
        elif kind == "@":
            if m := _domain(text, last + 1):
                low = start
                while low > ends["email"] and text[low - 1] in _local_back:
                    low -= 1
                if low < start:
                    ends["email"] = m.end()
                    spans.append((low, m.end(), "email"))
        elif kind == "+":
            if start >= ends["phone"] and (m := _phone_run(text, start)):
                ends["phone"] = m.end()
                if 9 <= len(_digits_of("", m[0])) <= 15:
                    spans.append((start, m.end(), "phone"))
        elif kind == "url":
            if start >= ends["url"] and (m := _url_rest(text, last + 1)):
                stop = last + 1 + len(m[0].rstrip(".,;:!?)"))
                if stop > last + 1:
                    ends["url"] = stop
                    spans.append((start, stop, "url"))
        elif start >= ends["account"] and not (start and text[start - 1].isalnum()):
            if m := _account(text, last + 1):
                begin, stop = m.span(1)
                if sum(c.isdigit() for c in m[1]) >= 4 and begin >= ends["account"]:
                    ends["account"] = stop
                    spans.append((begin, stop, "account"))
    order = {k: i for i, k in enumerate(KINDS)}
    spans.sort(key=lambda s: (s[0], order[s[2]]))
    return spans


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span as ``[KIND]``; of overlapping spans the first covers the others."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", redacted: bool = False
) -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone, base_sha256, spans and, if asked, redacted.

    A null text is empty: no spans, the digest of the empty string. Every input row gives one row,
    repeated keys included; other columns are not read. An empty table gives an empty result. Texts
    are searched whole, however long. Spans of different kinds may overlap; those of one start are in
    the order of `KINDS`. One pass, no shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in PATTERNS]
            digests, listed, cleaned = [], [], []
            for scalar in batch.column(1):
                whole = scalar.as_py() or ""
                spans = find(whole)
                base = [s for s in spans if s[2] in PATTERNS]
                for count, name in zip(counts, PATTERNS):
                    count.append(sum(s[2] == name for s in base))
                digests.append(hashlib.sha256(shown(base).encode()).hexdigest())
                listed.append(shown(spans))
                if redacted:
                    cleaned.append(redact(whole, spans))
            arrays = [
                batch.column(0),
                *(pa.array(c, pa.int64()) for c in counts),
                pa.array(digests, pa.string()),
                pa.array(listed, pa.string()),
            ]
            names = ["key", *(f"n_{k}" for k in PATTERNS), "base_sha256", "spans"]
            if redacted:
                arrays.append(pa.array(cleaned, pa.string()))
                names.append("redacted")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, {', '.join(f'n_{k} bigint' for k in PATTERNS)}, "
    schema += "base_sha256 string, spans string" + ", redacted string" * redacted
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
