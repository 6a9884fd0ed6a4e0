from __future__ import annotations

import hashlib
import random

from tallyward.llm import chat
from tallyward.llm.queries import BYTE_BPE

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\(", "\\{", "[", "<", "\\\\", "assistant"]


def conversations(seed, n=60):
    rng = random.Random(seed)
    parts = CONTROL + ["word", " ", "\n", "é", "漢字", "🙂", "  ", "a b", "<|endoftext|>", ""]
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 7)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
            role = rng.choice(["user", "assistant", "system", "[/INST]", None])
            rows.append((c, turn, role, rng.choice([text, text, text, None])))
    rng.shuffle(rows)
    return rows


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((t if t is not None else -(1 << 62), r or "", x or "") for c, t, r, x in rows if c == conv)
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_template_is_reversible():
    rng = random.Random(1)
    for _ in range(2000):
        turns = [
            ("".join(rng.choices(CONTROL, k=rng.randint(0, 3))), "".join(rng.choices(CONTROL, k=rng.randint(0, 8))))
            for _ in range(rng.randint(0, 4))
        ]
        formatted, spans = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert [chat.unescaped(formatted[a:b]) for a, b in spans] == [t for _, t in turns]


def test_mask_is_the_intersection_of_spans():
    # tokens over both edges, a character of two tokens, an empty turn
    mask, chars = chat.loss_mask([(2, 5), (6, 6), (8, 10)], [(0, 3), (3, 4), (3, 4), (4, 7), (7, 8), (8, 12)])
    assert mask == [1, 1, 1, 1, 0, 1]
    assert chars == [(2, 3), (3, 4), (4, 5), (8, 10)]


def test_characters_without_a_token_carry_no_loss():
    assert chat.loss_mask([(2, 9)], []) == ([], [])
    mask, chars = chat.loss_mask([(2, 9), (12, 15)], [(0, 1), (3, 5), (6, 8), (10, 11), (13, 14)])
    assert mask == [0, 1, 1, 0, 1]
    assert chars == [(3, 5), (6, 8), (13, 14)]


def test_tokens_cover_the_text():
    encoded = chat.load(BYTE_BPE).encode("<s>a[INST]  漢 字\n\n🙂 x [/INST]", add_special_tokens=False)
    covered = {i for a, b in encoded.offsets for i in range(a, b)}
    assert covered == set(range(len("<s>a[INST]  漢 字\n\n🙂 x [/INST]")))


def test_read_back_equals_the_input(spark):
    rows = conversations(3)
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(500, None, "user", "x"), (500, 0, "assistant", "y " * 20000), (500, 0, "assistant", "y " * 20000)]
    df = spark.createDataFrame(
        [(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, loss string"
    )
    formatted = chat.ChatFormat(BYTE_BPE).formatted(df)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    assert {c: v[:4] for c, v in got.items()} == brute(rows)
    one = formatted.filter("conv_id = -7").first()
    assert got[-7][4] == len(one.formatted) and len(one.mask) == len(one.ids) and sum(one.mask)
    assert chat.read_back(chat.ChatFormat(BYTE_BPE).formatted(df.limit(0))).count() == 0
