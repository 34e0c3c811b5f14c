"""Byte-pair encoding and decoding with a public vocabulary, by last-token states over a trie of distinct words.

A text is split as the vocabulary's own pre-tokenizer does. The distinct words of a
slice are visited in byte order, which is the depth-first order of their trie: the
prefix that a word shares with the one before keeps its states. The state of a prefix
is the last token of its encoding: the only token that ends the prefix and is
compatible with the last token of what precedes it. An encoding is read back from the
leaf: its last token, then the state where that token begins, and so on.

Two tokens are compatible if no merge across their border would come before the merges
that built them: the token pairs along the border live between the rank that makes
them and the rank that uses them up.

Defined results: a null or empty text has no ids and decodes to the empty text.
Special tokens written in a text are their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidewell.llm.arrays import per_slice

REMEMBERED = 64 << 20  # bytes of words and pairs kept during a task; they are forgotten together and learned again
LONGEST = 64  # characters of a word that is kept beyond its slice
WORD_BYTES, PAIR_BYTES = 260, 130  # what an entry takes beside its text and ids
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
# Texts of these characters only hold no contraction, and their letters, digits and spaces are those of the pattern.
PLAIN = re.compile(rf"[ -&(-~\n{_LETTER}]*")
PLAIN_WORD = re.compile(rf" ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        vocabulary = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
        self.ids = {spell(t): i for t, i in vocabulary.items() if t not in self.special}
        self.merge: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = (self.ids[spell(t)] for t in (pair if isinstance(pair, list) else pair.split(" ")))
            self.merge[a, b] = rank
            made.setdefault(self.ids[spell("".join(pair if isinstance(pair, list) else pair.split(" ")))], (rank, a, b))
        self.made = made
        size = 1 + max([*self.ids.values(), *self.special.values()])
        spelled = [b""] * size
        for token, number in self.ids.items():
            spelled[number] = token
        for token, number in self.special.items():
            spelled[number] = token.encode()
        self.lengths = np.array([len(t) for t in spelled], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.sizes = self.lengths.tolist()
        self.border = lru_cache(1 << 17)(self._border)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.held = 0
        self.border.cache_clear()

    def _border(self, token: int, right: bool) -> tuple[tuple[int, int, float], ...]:
        """Tokens that stand at the right (left) end of ``token`` while it is built: (token, made at, used at)."""
        lives, used = [], float("inf")
        while token in self.made:
            rank, a, b = self.made[token]
            lives.append((token, rank, used))
            token, used = (b if right else a), rank
        lives.append((token, -1, used))
        return tuple(lives)

    def compatible(self, left: int, right: int) -> bool:
        for a, a_made, a_used in self.border(left, True):
            for b, b_made, b_used in self.border(right, False):
                rank = self.merge.get((a, b))
                # a merge of the left token's own at the same rank lies further left and comes first
                if rank is not None and a_made < rank and b_made < rank and rank < a_used and rank <= b_used:
                    return False
        return True

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of each distinct word; ascending in bytes."""
        token_of, fits, lengths = self.ids.get, self.fits, self.sizes
        last: list[int] = []
        result, before = [], b""
        for word in words:
            size = len(word)
            if word.startswith(before):
                shared = len(before)
            else:
                shared = next(i for i, (x, y) in enumerate(zip(before, word)) if x != y)
                del last[shared:]
            for end in range(shared + 1, size + 1):
                begin = end - 1
                while True:  # exactly one token is compatible, so the order of the tries is free
                    token = token_of(word[begin:end])
                    if token is not None:
                        if not begin:
                            break
                        pair = last[begin - 1] << 32 | token
                        good = fits.get(pair)
                        if good is None:
                            good = fits[pair] = self.compatible(last[begin - 1], token)
                        if good:
                            break
                    elif not begin:
                        raise ValueError(f"no encoding of {word[:end]!r}")
                    begin -= 1
                last.append(token)
            found = []
            while size:
                found.append(last[size - 1])
                size -= lengths[found[-1]]
            found.reverse()
            result.append(array("I", found).tobytes())
            before = word
        return result

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words not seen yet."""
        spelled = sorted((word.encode(), word) for word in words)
        for (_, word), ids in zip(spelled, self.encode_words([w for w, _ in spelled])):
            self.known[word] = ids
            self.held += WORD_BYTES + len(word) + len(ids)

    def words(self, text: str) -> list[str]:
        """The words that the pre-tokenizer makes of a text."""
        if PLAIN.fullmatch(text):
            return PLAIN_WORD.findall(text)
        return [text[begin:end] for _, (begin, end) in self.splitter.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[str]:
        """The text cut around special tokens, leftmost and longest first."""
        rest, segments = text, []
        while True:
            at = min(((i, -len(t)) for t in self.special if (i := rest.find(t)) >= 0), default=None)
            if at is None:
                return [*segments, rest]
            i, n = at[0], -at[1]
            segments += [rest[:i], rest[i : i + n]]
            rest = rest[i + n :]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = []
        for text in texts:
            if any(t in text for t in self.special):
                cut.append([p if k % 2 else self.words(p) for k, p in enumerate(self.segments(text))])
            else:
                cut.append([self.words(text)])
        seen = set().union(*(part for parts in cut for part in parts if isinstance(part, list)))
        if self.held + PAIR_BYTES * len(self.fits) > REMEMBERED:
            self.forget()
        known = self.known
        fresh = [word for word in seen if word not in known]
        self.learn(fresh)
        get = known.__getitem__
        coded = [
            b"".join([
                b"".join(map(get, part)) if isinstance(part, list) else array("I", [self.special[part]]).tobytes()
                for part in parts
            ])
            for parts in cut
        ]
        for word in fresh:
            if len(word) > LONGEST:
                self.held -= WORD_BYTES + len(word) + len(known.pop(word))
        return coded

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.repeat(self.begins[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.spelling[place].tobytes().decode("utf-8", "replace")


@lru_cache(4)
def codec(path: str) -> Codec:
    """The codec of a file, once per process."""
    return Codec(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row; ids are little-endian unsigned 32-bit integers."""
    return _coded(docs, path, key, text, "ids binary, decoded string", lambda ids, decoded: (ids, decoded),
                  (pa.binary(), pa.string()), ("ids", "decoded"))


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, without shipping ids and texts."""
    return _coded(docs, path, key, text, "ids_sha256 string, decoded_sha256 string",
                  lambda ids, decoded: (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()),
                  (pa.string(), pa.string()), ("ids_sha256", "decoded_sha256"))


def _coded(docs, path, key, text, fields, shape, types, names):
    def make():
        own = codec(path)

        def work(batch, texts):
            sizes, first, second = [], [], []
            for ids in own.encode_batch(texts.to_pylist()):
                numbers = np.frombuffer(ids, "<u4")
                a, b = shape(ids, own.decode(numbers))
                sizes.append(len(numbers))
                first.append(a)
                second.append(b)
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(first, types[0]), pa.array(second, types[1])],
                ["id", "n_tokens", *names],
            )

        return work

    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(per_slice(make, "text", lambda: codec(path).forget()), f"id long, n_tokens long, {fields}").withColumnRenamed("id", key)
