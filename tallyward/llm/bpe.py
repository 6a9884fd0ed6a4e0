"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word is a row of symbols. The leaves of the tree hold the rank of the pair that starts at each
symbol (none: infinity), every inner node the smaller rank of its children, the left one on ties.
The root therefore names the leftmost pair of the lowest rank. A merge changes the pair itself, the
pair to its left and the pair that vanishes: three point updates of O(log n) each, until the root is
infinite. Long words cost O(n log n), where scanning for the best pair would take O(n^2).

`PairTrees` holds the trees of many words of one size as rows of one array: a step reads all roots,
descends all trees and updates their leaves and inner nodes level by level. Words longer than
`LONGEST` symbols have a `PairTree` each.

The vocabulary file is a parameter; each Python worker reads it once. No word reaches over white
space, so texts are looked up by their stretches between white space. A worker keeps those it has met
in two generations of bounded size: what is used again moves to the young one, and when that is full
the old one goes. That changes nothing but time.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyward.llm.generations import Generations
from tallyward.llm.vocabularies import vocabulary_file

NONE = 1 << 60
NO_RANK = (1 << 31) - 1  # the same in the arrays of many trees
LONGEST = 62
GENERATION = 50_000  # stretches of text that a generation of the cache holds
CACHED_LETTERS = 64
SLICE = 1 << 17  # letters of text whose new words are encoded together
# Fixed value: the white space class of the vocabulary's patterns.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# ids as text, decoded text, number of ids
Found = tuple[str, str, int]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Fixed rule: printable Latin-1 bytes stand for themselves, the others take the code points from
    256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTree:
    """Minimum tree over the pair ranks of one word."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        self.node = [NONE] * size + ranks + [NONE] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def lowest(self) -> int:
        """Position of the leftmost pair of the lowest rank, -1 if no pair can merge."""
        node, best, i = self.node, self.node[1], 1
        if best == NONE:
            return -1
        while i < self.size:
            i = 2 * i if node[2 * i] == best else 2 * i + 1
        return i - self.size

    def put(self, position: int, rank: int) -> None:
        node, i = self.node, position + self.size
        node[i] = rank
        while i > 1:
            i //= 2
            best = min(node[2 * i], node[2 * i + 1])
            if node[i] == best:
                break
            node[i] = best


class PairTrees:
    """Minimum trees over the pair ranks of many words, a row of leaves each."""

    def __init__(self, ranks: np.ndarray):
        self.rows, self.size = ranks.shape
        node = np.full((self.rows, 2 * self.size), NO_RANK, np.int32)
        node[:, self.size :] = ranks
        half = self.size
        while half > 1:
            np.minimum(
                node[:, half : 2 * half : 2],
                node[:, half + 1 : 2 * half : 2],
                out=node[:, half // 2 : half],
            )
            half //= 2
        self.node = node.ravel()
        self.root = np.arange(self.rows) * (2 * self.size)

    def lowest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest rank, leftmost position that has it) in the trees of these rows."""
        root = self.root[rows]
        best, i = self.node[root + 1], np.ones(len(rows), np.int64)
        half = 1
        while half < self.size:
            i *= 2
            i += self.node[root + i] != best
            half *= 2
        return best, i - self.size

    def put(self, rows: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        """Set leaves, several of a row too if their positions differ, and renew what is above."""
        root, i = self.root[rows], position + self.size
        self.node[root + i] = rank
        half = self.size
        while half > 1:
            i >>= 1
            below = root + 2 * i
            self.node[root + i] = np.minimum(self.node[below], self.node[below + 1])
            half //= 2


class Bpe:
    """Encoder and decoder of a vocabulary file with byte-level symbols and a word-end suffix."""

    def __init__(self, file: str):
        with open(vocabulary_file(file), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {
            i: t for t, i in self.special.items()
        }
        self.name = {i: str(i) for i in self.token}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        # the same as arrays: pairs packed and sorted, their ranks, what each rank makes
        self.none = max(self.token) + 1
        pairs = np.array([a * (self.none + 1) + b for a, b in self.merge], np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.ranks = np.array([r for r, _ in self.merge.values()], np.int32)[order]
        self.made = np.zeros(max(len(model["merges"]), 1), np.int32)
        for rank, made in self.merge.values():
            self.made[rank] = made
        self.symbols = byte_symbols()
        self.inner = np.array([self.vocab[x] for x in self.symbols], np.int32)
        self.last = np.array([self.vocab[x + self.suffix] for x in self.symbols], np.int32)
        split = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.words = regex.compile(split.replace(r"\s", SPACE)).findall
        self.gap = regex.compile(f"[{SPACE}]+")
        self.marks = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ).split
        self.cache: Generations[Found] = Generations(GENERATION, CACHED_LETTERS)

    def long_word(self, symbols: list[int]) -> list[int]:
        """Ids of one word, by merges from the root of its pair tree."""
        ids, n = list(symbols), len(symbols)
        merge, none = self.merge, (NONE, -1)
        tree = PairTree([merge.get(pair, none)[0] for pair in zip(ids, ids[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1") * n
        while (i := tree.lowest()) >= 0:
            j = after[i]
            ids[i] = merge[ids[i], ids[j]][1]
            alive[j] = 0
            k = after[i] = after[j]
            if j < n - 1:
                tree.put(j, NONE)
            if k < n:
                before[k] = i
                tree.put(i, merge.get((ids[i], ids[k]), none)[0])
            else:
                tree.put(i, NONE)
            if (h := before[i]) >= 0:
                tree.put(h, merge.get((ids[h], ids[i]), none)[0])
        return [x for x, here in zip(ids, alive) if here]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, `NO_RANK` for those that do not merge."""
        pair = a.astype(np.int64) * (self.none + 1) + b
        at = np.searchsorted(self.pairs, pair).clip(max=len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], NO_RANK)

    def many_words(self, ids: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """Ids of words whose symbols are rows of ``ids``, one place free at either end."""
        count, width = ids.shape
        trees = PairTrees(self.rank(ids[:, :-1], ids[:, 1:]))
        flat, base = ids.ravel(), np.arange(count) * width
        after = np.tile(np.arange(1, width + 1), count)
        before = np.tile(np.arange(-1, width - 1), count)
        alive = np.zeros((count, width), bool)
        alive[:, 1:] = np.arange(1, width) <= lengths[:, None]
        alive = alive.ravel()
        rows = np.arange(count)
        while len(rows):
            best, i = trees.lowest(rows)
            live = best != NO_RANK
            if not live.all():
                rows, best, i = rows[live], best[live], i[live]
                if not len(rows):
                    break
            start = base[rows]
            j = after[start + i]
            k = after[start + j]
            h = before[start + i]
            flat[start + i] = self.made[best]
            alive[start + j] = False
            after[start + i] = k
            before[start + k] = i
            left, mid, right = flat[start + h], flat[start + i], flat[start + k]
            rank = self.rank(np.concatenate([mid, left]), np.concatenate([right, mid]))
            trees.put(
                np.tile(rows, 3),
                np.concatenate([j, i, h]),
                np.concatenate([np.full(len(rows), NO_RANK, np.int32), rank]),
            )
        kept = alive.reshape(count, width)
        found = ids[kept].tolist()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        return [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def word_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; words of about one length are encoded together."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        symbols = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum(lengths)
        if len(raw):
            final = np.array([r[-1] for r in raw], np.int64)
            symbols[ends - 1] = self.last[final]
        found: list[list[int]] = [[]] * len(raw)
        size = 4
        while size < LONGEST + 2:
            size *= 2
            chosen = np.flatnonzero((lengths <= size - 2) & (lengths > (size // 2 - 2) * (size > 8)))
            if not len(chosen):
                continue
            place = np.arange(1, size - 1)
            inside = place <= lengths[chosen][:, None]
            ids = np.full((len(chosen), size + 1), self.none, np.int32)
            at = (ends - lengths)[chosen][:, None] + place - 1
            ids[:, 1 : size - 1][inside] = symbols[at[inside]]
            for n, one in zip(chosen.tolist(), self.many_words(ids, lengths[chosen])):
                found[n] = one
        for n in np.flatnonzero(lengths > LONGEST).tolist():
            found[n] = self.long_word(symbols[ends[n] - lengths[n] : ends[n]].tolist())
        return found

    def normal(self, text: str) -> str:
        """Composed form, lower case letter by letter."""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the final sigma rule looks at neighbours; the vocabulary does not
            return "".join(map(str.lower, text))
        return text.lower()

    def stretches(self, text: str) -> list[str]:
        """What stands between white space."""
        if any(x in text for x in "\x1c\x1d\x1e\x1f"):  # white space to Python alone
            return [x for x in self.gap.split(text) if x]
        return text.split()

    def parts(self, text: str) -> Iterator[str]:
        """A text in parts of about `SLICE` letters that end at white space."""
        begin = 0
        while len(text) - begin > SLICE and (gap := self.gap.search(text, begin + SLICE)):
            yield text[begin : gap.start()]
            begin = gap.end()
        yield text[begin:] if begin else text

    def learn(self, stretches: Iterable[str]) -> dict[str, Found]:
        """(ids as text, decoded text, number of ids) of new stretches, all encoded together."""
        words, normal, marks, special = self.words, self.normal, self.marks, self.special
        made: dict[str, list[str | int]] = {}
        for stretch in stretches:
            if "<|" not in stretch:
                made[stretch] = words(stretch.lower() if stretch.isascii() else normal(stretch))
                continue
            made[stretch] = [
                piece
                for part in marks(stretch)
                for piece in ([special[part]] if part in special else words(normal(part)))
            ]
        pieces = dict.fromkeys(chain.from_iterable(made.values()))
        plain = [p for p in pieces if isinstance(p, str)]
        ids = {i: [i] for i in special.values()} | dict(zip(plain, self.word_ids(plain)))
        name, token, join = self.name.__getitem__, self.token.__getitem__, " ".join
        found = {}
        for stretch, pieces in made.items():
            if len(pieces) == 1:
                mine = ids[pieces[0]]
            else:
                mine = list(chain.from_iterable(map(ids.__getitem__, pieces)))
            found[stretch] = join(map(name, mine)), join(map(token, mine)), len(mine)
        return found

    def found(self, texts: list[list[str]]) -> Iterator[list[Found]]:
        """What is known of the stretches of each text; new ones are learned first."""
        known = self.cache.having(chain.from_iterable(texts), self.learn)
        for stretches in texts:
            yield [x for x in map(known.__getitem__, stretches) if x[2]]

    def encode(self, text: str) -> list[int]:
        found = (f for part in self.parts(text) for f in self.found([self.stretches(part)]))
        return [int(i) for one in found for ids, _, _ in one for i in ids.split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by a space: the vocabulary names no decoder."""
        return " ".join(self.token[i] for i in ids if i in self.token)


@lru_cache(maxsize=2)
def load(file: str) -> Bpe:
    """The encoder of a file, one per Python worker."""
    return Bpe(file)


def encoded(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) of every text. Null is empty; an empty text has no ids."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(file)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                one = batch.slice(low, 256)
                ids = [bpe.encode(t or "") for t in one.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column(0),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                    ],
                    ["key", "ids", "decoded"],
                )

    return (
        docs.select(key, text)
        .mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
        .withColumnRenamed("key", key)
    )


def digests(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every text, without keeping the ids.

    A null text is empty; an empty one, and one of white space alone, has no tokens and the digests of
    nothing. Rows of equal keys or texts are rows of their own, in no order. Very long texts are
    encoded in parts that end at white space; a word of any length stays whole. Without rows there is
    no result. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(file)
        for batch in batches:
            rows = []
            for texts in _slices(batch.column(1)):
                if len(texts) == 1:
                    rows.append(_digest(f for p in bpe.parts(texts[0]) for f in bpe.found([bpe.stretches(p)])))
                else:
                    rows += [_digest([f]) for f in bpe.found([bpe.stretches(t) for t in texts])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [
                    pa.array([r[c] for r in rows], t)
                    for c, t in enumerate((pa.int64(), pa.string(), pa.string()))
                ],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return (
        docs.select(key, text)
        .mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("key", key)
    )


def _digest(parts: Iterable[list[Found]]) -> tuple[int, str, str]:
    """Number of tokens and digests of a text whose parts come one after the other."""
    count, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
    for part in parts:
        if not part:
            continue
        gap = b" " if count else b""
        ids.update(gap + " ".join([x[0] for x in part]).encode())
        decoded.update(gap + " ".join([x[1] for x in part]).encode())
        count += sum([x[2] for x in part])
    return count, ids.hexdigest(), decoded.hexdigest()


def _slices(column: pa.Array) -> Iterator[list[str]]:
    """Texts that come to about `SLICE` letters; a longer one alone. Null is empty."""
    texts, size = [], 0
    for scalar in column:
        text = scalar.as_py() or ""
        if texts and size + len(text) > SLICE:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts
