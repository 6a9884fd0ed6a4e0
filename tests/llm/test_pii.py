from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import pii


def base(text):
    """The base kinds by their patterns."""
    found = []
    for place, (kind, pattern) in enumerate(pii.PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), place, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def own(text):
    return [s for s in pii.find(text) if s[2] in pii.PATTERNS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()ab_%🙂é:/", max_size=60))
def test_base_kinds_equal_their_patterns(text):
    assert own(text) == base(text)


def test_base_kinds_in_dense_texts():
    rng = random.Random(2)
    parts = ["4111 1111 1111 1111", "4111111111111111", "+1 (555) 123-4567", "1.2.3.4", "256.1.1.1"]
    parts += ["a@b.co", "@x.y", "a@b", "x.y@z-.q.r", " ", ".", "-", "0", "12", "🙂", "+", "a"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert own(text) == base(text)


def test_added_kinds():
    text = "see https://a.example/x?y=1. Account no: 12345678, IBAN DE44 5001 0517 5407 mailto:q"
    shown = pii.shown(pii.find(text))
    for want in ("https://a.example/x?y=1", "12345678", "DE44 5001 0517 5407", "mailto:q"):
        at = text.index(want)
        assert f":{at}:{at + len(want)}" in shown
    assert pii.redact("mail a@b.co now", pii.find("mail a@b.co now")) == "mail [EMAIL] now"


def test_cues_and_schemes_in_any_case():
    cues = ["Tax ID: ", "User ID ", "Customer Id ", "IBan ", "Ssn ", "ssn ", "TAX ID ", "aCCt "]
    for before in ("", "İ🙂É "):
        for cue in cues:
            at = len(before + cue)
            assert pii.find(f"{before}{cue}912345678.") == [(at, at + 9, "account")]
        at = len(before)
        assert pii.find(f"{before}HttpS://A.example/X") == [(at, at + 19, "url")]
    assert pii.find("İtax ID 912345678") == []  # inside a word
    assert pii.lowered("AÉİ\u212a\ud800Z") == "aÉİ\u212a\ud800z"


def test_rows(spark):
    rows = [(1, "a@b.co 1.2.3.4", 9), (1, None, 9), (None, "", 9), (2, "+12345678901 " * 5000, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    got = pii.personal_data(df, redacted=True).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == [
        (0, 0, 0, 0, 0),
        (1, 0, 0, 0, 0),
        (1, 1, 1, 0, 0),
        (2, 0, 0, 0, 5000),
    ]
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r.base_sha256 == empty and r.spans == "" for r in got) == 2
    assert pii.personal_data(df.limit(0)).count() == 0
