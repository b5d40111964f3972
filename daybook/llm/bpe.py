"""Byte-level BPE, encoded in batched numpy merge rounds, and decoded.

A text is cut at special tokens and then into words by the pattern of this kind of
tokenizer. The symbols of many different words lie in one flat array. In each round, each
word's pair of lowest rank is merged wherever it occurs in the word; ranks come from a
binary search over sorted pair keys. After a round only the pairs beside a merge are looked
up again, and words without a pair left leave the array. Words that have been encoded are
remembered, up to ``REMEMBERED`` of them, so each costs its rounds only once.

The vocabulary is read from a tokenizer file by the driver and broadcast; its size is fixed
by the file.

Defined results: a null text is an empty one, with no tokens. Texts of any length are encoded
whole. Rows with a null or repeated id have a result each. Columns other than doc_id and
text don't matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

REMEMBERED = 200_000
WORDS_AT_ONCE = 50_000
TEXT_AT_ONCE = 1 << 20
NO_RANK = np.int32(2**31 - 1)
# Fixed pattern of this kind of tokenizer, with white space as Unicode defines it.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    rf" ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a vocabulary file.

    Printable bytes stand for themselves, others for characters from 256 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        ids = described["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {symbol: byte for byte, symbol in enumerate(symbols)}
        self.special = {x["content"]: x["id"] for x in described["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        tokens = [b""] * size
        for token, number in ids.items():
            tokens[number] = bytes(byte_of[symbol] for symbol in token)
        for token, number in self.special.items():
            tokens[number] = token.encode()
        self.first = np.array([ids[symbol] for symbol in symbols], np.int32)
        pairs = [
            pair if isinstance(pair, list) else pair.split(" ")
            for pair in described["model"]["merges"]
        ]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    @classmethod
    def restored(cls, state: dict) -> Vocabulary:
        """The vocabulary whose attributes were broadcast."""
        vocabulary = cls.__new__(cls)
        vars(vocabulary).update(state)
        return vocabulary

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of symbols, NO_RANK for those that don't merge."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def encode_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and the number of ids of each word."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sizes = np.array([len(word) for word in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        # Rank of the pair that starts at a symbol; the last symbol of a word has none.
        rank = np.full(len(symbols), NO_RANK, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done_words, done_symbols = [], []
        while len(symbols):
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(heads, len(symbols)))
            least = np.minimum.reduceat(rank, heads)
            goes_on = np.repeat(least != NO_RANK, lengths)
            if not goes_on.all():
                done_words.append(word[~goes_on])
                done_symbols.append(symbols[~goes_on])
                least = np.repeat(least, lengths)[goes_on]
                symbols, word, rank = symbols[goes_on], word[goes_on], rank[goes_on]
            else:
                least = np.repeat(least, lengths)
            if not len(symbols):
                break
            at = np.flatnonzero(rank == least)
            # In a run of overlapping pairs every second one merges, from the left.
            new_run = np.append(True, np.diff(at) != 1)
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            place = np.cumsum(stays) - 1
            symbols, word, rank = symbols[stays], word[stays], rank[stays]
            at = place[at]
            changed = np.concatenate([at, at[at > 0] - 1])
            changed = changed[changed + 1 < len(symbols)]
            inner = word[changed] == word[changed + 1]
            rank[at] = NO_RANK
            changed = changed[inner]
            rank[changed] = self.rank(symbols[changed], symbols[changed + 1])
        if not done_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(word, minlength=len(words))

    def decode_ids(self, ids: np.ndarray) -> bytes:
        """The bytes that the tokens of ids stand for."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        inside = np.arange(total) - np.repeat(ends - sizes, sizes)
        return self.bytes[np.repeat(self.starts[ids], sizes) + inside].tobytes()


class Codec:
    """Encodes and decodes texts, and remembers words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        """Remember no words. Word number n has ``counts[n]`` ids, from ``starts[n]`` on."""
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        words = []
        for part in self.special.split(text):
            words.extend([part] if part in self.vocabulary.special else self.pattern.findall(part))
        return words

    def learn(self, words: set[str]) -> None:
        """Encode words that are not remembered yet."""
        special = self.vocabulary.special
        new = [word for word in words if word not in self.known]
        for start in range(0, len(new), WORDS_AT_ONCE):
            part = new[start : start + WORDS_AT_ONCE]
            plain = [word.encode() for word in part if word not in special]
            ids, counts = self.vocabulary.encode_words(plain)
            names = [word for word in part if word not in special]
            for word in (word for word in part if word in special):
                ids, counts = np.append(ids, np.int32(special[word])), np.append(counts, 1)
                names.append(word)
            self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))
            ends = len(self.ids) + np.cumsum(counts)
            self.starts = np.concatenate([self.starts, ends - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        words = [self.split(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        self.learn(set().union(*words))
        return [self._ids(of_text) for of_text in words]

    def _ids(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[numbers] - (ends - counts), counts)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.vocabulary.decode_ids(ids).decode("utf-8", errors="replace")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) with the ids of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(path)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary.restored(shared.value))
        for batch in batches:
            for some in _some(batch):
                ids = codec.encode([text.as_py() or "" for text in some.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([list(x) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of_batches, f"doc_id {kind}, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(Vocabulary(path)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary.restored(shared.value))
        for batch in batches:
            texts = [
                codec.decode(np.array(ids.as_py(), np.int64)) if ids.is_valid else None
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(of_batches, f"doc_id {kind}, text string")


def _some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with about ``TEXT_AT_ONCE`` characters each, or one row."""
    start = total = 0
    for row, size in enumerate(pa.compute.utf8_length(batch.column(1)).to_pylist()):
        total += size or 0
        if total >= TEXT_AT_ONCE:
            yield batch.slice(start, row + 1 - start)
            start, total = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """Digests of each text's ids and of the text decoded from them, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(path)))

    def digest(content: bytes) -> str:
        return hashlib.sha256(content).hexdigest()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary.restored(shared.value))
        decimal = [str(number) for number in range(len(codec.vocabulary.sizes))]
        for batch in batches:
            for some in _some(batch):
                ids = codec.encode([text.as_py() or "" for text in some.column(1)])
                listed = [",".join(map(decimal.__getitem__, x.tolist())) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([digest(x.encode()) for x in listed]),
                        pa.array([digest(codec.decode(x).encode()) for x in ids]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of_batches, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
