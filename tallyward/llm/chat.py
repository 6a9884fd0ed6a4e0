"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template whose control strings cannot occur inside a text,
because texts are escaped reversibly. It is then encoded once, with the offsets of each token. Turn
spans and token spans are both sorted, so the tokens of a turn are found by binary search, and the
loss mask of the conversation is the intersection of its assistants' spans with its tokens' spans.

Whatever the vocabulary does at a turn's edge, the mask is exact in characters: a token that reaches
over the edge counts only with the part inside, and tokens that share a character (the bytes of one
character may be several tokens) count it once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.vocabularies import vocabulary_file

# The control strings of the template and the escape of the sign they start with.
OPEN, CLOSE, END, ESCAPE = "[INST]", "[/INST]", "</s>", "\\"
HEAD = "<s>"

Turn = tuple[str, str]
Span = tuple[int, int]


def escaped(text: str) -> str:
    """The text without a bracket of a control string: ``[``, ``<`` and the escape get an escape."""
    return text.replace(ESCAPE, ESCAPE * 2).replace("[", ESCAPE + "(").replace("<", ESCAPE + "{")


def unescaped(text: str) -> str:
    parts = text.split(ESCAPE * 2)
    return ESCAPE.join(p.replace(ESCAPE + "(", "[").replace(ESCAPE + "{", "<") for p in parts)


def render(turns: Sequence[Turn]) -> tuple[str, list[Span]]:
    """The formatted conversation, and where each turn's escaped text stands in it.

    A turn is ``<s>role[INST]text[/INST]`` or, for the assistant, ``<s>role[INST][/INST]text</s>``:
    roles and texts are escaped, so the markers part them.
    """
    parts, spans, at = [], [], 0
    for role, text in turns:
        before = HEAD + escaped(role) + OPEN + (CLOSE if role == "assistant" else "")
        body = escaped(text)
        after = END if role == "assistant" else CLOSE
        spans.append((at + len(before), at + len(before) + len(body)))
        parts += [before, body, after]
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(HEAD)[1:]:
        role, _, rest = part.partition(OPEN)
        text = rest[len(CLOSE) : -len(END)] if rest.endswith(END) else rest[: -len(CLOSE)]
        turns.append((unescaped(role), unescaped(text)))
    return turns


def loss_mask(spans: Sequence[Span], offsets: Sequence[Span]) -> tuple[list[int], list[Span]]:
    """(1 for each token that carries loss, else 0; the characters under the mask as spans).

    ``spans`` are the sorted turns that carry loss, ``offsets`` the sorted spans of the tokens. A
    character that no token has is in no span.
    """
    starts, ends = [a for a, _ in offsets], [b for _, b in offsets]
    mask, chars = [0] * len(offsets), []
    for a, b in spans:
        at = a
        for i in range(bisect_right(ends, a), bisect_left(starts, b)):
            x, y = max(starts[i], at), min(ends[i], b)
            mask[i] = 1
            if x < y:
                chars.append((x, y))
                at = y
    return mask, chars


@lru_cache(maxsize=2)
def load(file: str):
    """The tokenizer of a file, one per Python worker; its special strings are ordinary text."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary_file(file))
    found.encode_special_tokens = True
    return found


@dataclass(frozen=True)
class ChatFormat:
    """``file`` names the vocabulary; texts of ``loss_role`` carry the loss."""

    file: str
    loss_role: str = "assistant"

    def gathered(self, rows: DataFrame) -> DataFrame:
        """(conv_id, turns): one row per conversation, turns in order.

        Order is by turn, null first, then role and text; a row repeated in full is a turn again.
        A conversation is one training row, so its turns meet in one row; how many rows share an id
        is decided by the data, and conversations that are copies of each other stay apart.
        """
        turns = F.array_sort(
            F.collect_list(
                F.struct(
                    F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 62))).alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        )
        return rows.groupBy("conv_id").agg(turns.alias("turns"))

    def formatted(self, rows: DataFrame) -> DataFrame:
        """(conv_id, formatted, ids, mask, loss) for each conversation; loss is the masked spans.

        Null roles and texts are empty, a null id is an id. An empty table gives an empty result. Rows
        that repeat an id and a turn are turns of their own, in the order of role and text. Very long
        texts are rendered and encoded whole, so a conversation must fit into one row. Columns other
        than conv_id, turn, role and text are not read.
        """
        kind = rows.schema["conv_id"].dataType.simpleString()
        file, role = self.file, self.loss_role

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizer = load(file)
            for batch in batches:
                for start in range(0, batch.num_rows, 64):
                    part = batch.slice(start, 64)
                    turns = [[(t["role"], t["text"]) for t in row] for row in part.column(1).to_pylist()]
                    rendered = [render(t) for t in turns]
                    encoded = tokenizer.encode_batch([r for r, _ in rendered], add_special_tokens=False)
                    masks, losses = [], []
                    for own, (_, spans), tokens in zip(turns, rendered, encoded):
                        wanted = [s for (r, _), s in zip(own, spans) if r == role]
                        mask, chars = loss_mask(wanted, tokens.offsets)
                        masks.append(mask)
                        losses.append([list(c) for c in chars])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            pa.array([r for r, _ in rendered], pa.string()),
                            pa.array([e.ids for e in encoded], pa.list_(pa.int32())),
                            pa.array(masks, pa.list_(pa.int8())),
                            pa.array(losses, pa.list_(pa.list_(pa.int32()))),
                        ],
                        ["conv_id", "formatted", "ids", "mask", "loss"],
                    )

        return self.gathered(rows).mapInArrow(
            run,
            f"conv_id {kind}, formatted string, ids array<int>, mask array<tinyint>, "
            "loss array<array<int>>",
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each output row."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                # escapes may be cut between tokens, so pieces are joined before they are undone
                masked = unescaped("".join(text[a:b] for a, b in loss))
                rows.append(
                    (
                        len(turns),
                        hashlib.sha256(whole.encode()).hexdigest(),
                        len(masked),
                        hashlib.sha256(masked.encode()).hexdigest(),
                        len(text),
                    )
                )
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
