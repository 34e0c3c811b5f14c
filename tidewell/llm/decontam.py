"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance.

Words are lower-cased runs of letters, marks and digits; in scripts written without spaces, and among symbols beyond
ASCII, each character is a word. Spaces and punctuation of any script separate. A document holds an item of n words if some stretch of it is within ``n * share`` word edits (insert, delete,
replace) of the item.

* Windows. An item is cut into one piece more than edits are allowed, so an allowed copy keeps a
  piece unedited. Wherever the first words of a piece (three at most) stand in a document,
  a window of the item's size is laid as if they stood at their place in the item.
* Embedding. A walk of 3 n steps over a window (or an item) writes the word it stands on and goes
  on by one word or none, as a hash of the step and the word says. Few edits apart, two walks
  soon meet again, so edit distance becomes Hamming distance.
* Sampling. A repetition hashes ``SAMPLED`` places of the walk; a window and an item of equal size that
  agree on them are a candidate. The number of repetitions follows from the recall asked for
  and the agreement of walks at the largest allowed distance.
* Each candidate is checked by the exact edit distance of the item to any stretch
  around the window (bit-parallel dynamic programming).

Items are taken in blocks of bounded size, so what a task holds does not grow with the benchmark; each
block is one pass over the documents.

Defined results: null and empty texts hold nothing; items without an id or without words are not searched; items of
fewer than ``least_words`` words are held only as they are, without an edit; items of equal text are all reported;
repeated documents are reported each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.arrays import find_terms, flat, mix, per_slice, strings, word_hashes

SHARE = 0.2
LEAST_WORDS = 5
SAMPLED = 2
ANCHOR = 3
AGREEMENT = 0.3
RECALL = 0.995
WALKS = 3
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repetitions(recall: float = RECALL, agreement: float = AGREEMENT, sampled: int = SAMPLED) -> int:
    """Repetitions after which a pair whose walks agree that often is missed with probability 1 - recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def embed(words: np.ndarray, start: np.ndarray, size: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """CGK walks over the stretches words[start : start + size]; beyond its end a stretch has the word 0."""
    padded = np.append(words, np.uint64(0))
    place = np.zeros(len(start), np.int64)
    out = np.zeros((len(start), steps), np.uint64)
    salt = mix(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64(walk << 32))
    for j in range(steps):
        word = np.where(place < size, padded[np.minimum(start + place, len(words))], np.uint64(0))
        out[:, j] = word
        place += (mix(word + salt[j]) >> np.uint64(63)).astype(np.int64)
    return out


def sample_keys(words: np.ndarray, start: np.ndarray, size: np.ndarray, times: int) -> np.ndarray:
    """(stretch, repetition) hashes of the sampled places; stretches of other sizes never agree."""
    keys = np.zeros((len(start), times), np.uint64)
    if not len(start):
        return keys
    rng = np.random.default_rng(5)
    shares = rng.random((times, SAMPLED))
    rows = np.arange(len(start))
    for walk in range(WALKS):
        walked = embed(words, start, size, walk, 3 * int(size.max()))
        for rep in range(walk, times, WALKS):
            key = size.astype(np.uint64) * _STEP + np.uint64(rep)
            for share in shares[rep]:
                key = mix(key + walked[rows, (share * 3 * size).astype(np.int64)])
            keys[:, rep] = key
    return keys


def stretch_distance(item: list[int], region: list[int]) -> int:
    """Smallest edit distance between ``item`` and any stretch of ``region`` (the empty one included)."""
    m = len(item)
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    whole, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = whole, 0, m, m
    for word in region:
        same = places.get(word, 0) | down
        zero = (((same & up) + up) ^ up) | same
        grow = down | (whole & ~(up | zero))
        fall = up & zero
        score += bool(grow & top) - bool(fall & top)
        grow = (grow << 1) & whole
        up = ((fall << 1) | (whole & ~(grow | zero))) & whole
        down = grow & zero
        best = min(best, score)
    return best


@dataclass
class Block:
    """A block of items, ready to be searched."""

    ids: list[int]
    words: np.ndarray
    first: np.ndarray
    allowed: np.ndarray
    anchor: np.ndarray
    anchor_item: np.ndarray
    anchor_place: np.ndarray
    key: np.ndarray
    key_item: np.ndarray
    times: int

    @classmethod
    def of(cls, ids: list[int], texts: list[str], share: float = SHARE, least_words: int = LEAST_WORDS,
           recall: float = RECALL) -> Block:
        hashes, first = text_words(pa.array(texts, pa.large_string()))
        n = np.diff(first)
        used = np.flatnonzero(n)
        allowed = np.where(n >= least_words, n * share, 0).astype(np.int64)
        anchors = []
        for item in used:
            pieces = allowed[item] + 1
            width = min(ANCHOR, n[item] // pieces)
            for piece in range(pieces):
                place = piece * n[item] // pieces
                run = hashes[first[item] + place : first[item] + place + width]
                anchors.append((run_hashes(run, width)[0], item, place))
        anchors.sort()
        times = repetitions(recall)
        keys = sample_keys(hashes, first[used], n[used], times)
        order = np.argsort(keys.ravel(), kind="stable")
        return cls(
            list(ids), hashes, first, allowed, np.array([a[0] for a in anchors], np.uint64),
            np.array([a[1] for a in anchors], np.int64), np.array([a[2] for a in anchors], np.int64),
            keys.ravel()[order], np.repeat(used, times)[order], times,
        )

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, size) of the windows laid at anchors; a window may reach beyond its text by clipping."""
        low = np.zeros(1 << 16, bool)
        low[(self.anchor & np.uint64(0xFFFF)).astype(np.int64)] = True
        found = []
        for width in range(1, ANCHOR + 1):
            runs = run_hashes(hashes, width)
            near = np.flatnonzero(low[(runs & np.uint64(0xFFFF)).astype(np.int64)])
            word, entry = equal_pairs(runs[near], self.anchor)
            found.append((near[word], entry))
        at, entry = (np.concatenate(x) for x in zip(*found))
        item = self.anchor_item[entry]
        text = np.searchsorted(first, at, "right") - 1
        size = self.first[item + 1] - self.first[item]
        start = np.maximum(at - self.anchor_place[entry], first[text])
        laid = np.unique(np.stack([text, start, size], axis=1), axis=0) if len(at) else np.zeros((0, 3), np.int64)
        return laid[:, 0], laid[:, 1], laid[:, 2]

    def find(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(text number, item number, distance) of the items held by each text."""
        hashes, first = text_words(texts)
        if not len(self.anchor) or not len(hashes):
            return []
        text, start, size = self.windows(hashes, first)
        reach = np.minimum(size, first[text + 1] - start)
        best: dict[tuple[int, int], int] = {}
        for lo in range(0, len(text), 4096):
            part = slice(lo, lo + 4096)
            keys = _clipped_keys(hashes, start[part], size[part], reach[part], self.times)
            row, entry = equal_pairs(keys.ravel(), self.key)
            pairs = np.unique(np.stack([row // self.times + lo, self.key_item[entry]], axis=1), axis=0)
            for window, item in pairs.tolist():
                t, k = int(text[window]), int(self.allowed[item])
                if best.get((t, item), k + 1) == 0:
                    continue
                begin = max(int(start[window]) - k, int(first[t]))
                end = min(int(start[window] + size[window]) + k, int(first[t + 1]))
                own = self.words[self.first[item] : self.first[item + 1]].tolist()
                distance = stretch_distance(own, hashes[begin:end].tolist())
                if distance <= k:
                    best[t, item] = min(distance, best.get((t, item), distance))
        return [(t, item, d) for (t, item), d in sorted(best.items())]


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, at its first word; runs across texts are ruled out later, by the check."""
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        total = mix(total + words[k : k + len(total)]) + np.uint64(width)
    return total


def _clipped_keys(hashes, start, size, reach, times):
    """Keys of windows of ``size`` words of which the text has the first ``reach``."""
    if (reach == size).all():
        return sample_keys(hashes, start, size, times)
    total = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], size)
    inside = place < np.repeat(reach, size)
    at = np.minimum(np.repeat(start, size) + place, len(hashes) - 1)
    return sample_keys(np.where(inside, hashes[at], np.uint64(0)), total[:-1], size, times)


def equal_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with left[i] == right[j]; ``right`` is sorted."""
    lo, hi = np.searchsorted(right, left, "left"), np.searchsorted(right, left, "right")
    n = hi - lo
    i = np.repeat(np.arange(len(left)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and per text its first word's number."""
    data, bounds = flat(pc.utf8_lower(strings(texts)))
    starts, ends, first = find_terms(data, bounds)
    return word_hashes(data, starts, ends, fold=False), first


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text", share: float = SHARE,
                least_words: int = LEAST_WORDS, recall: float = RECALL):
    """The items in blocks of about ``BLOCK_ITEMS`` and ``BLOCK_CHARS`` at most, one at a time."""
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null and text is not null"
    )
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(-(-total["n"] // BLOCK_ITEMS), -(-total["chars"] // BLOCK_CHARS))
    for number in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number).orderBy("id", "text").collect()
        if mine:
            yield Block.of([r["id"] for r in mine], [r["text"] for r in mine], share, least_words, recall)


def find_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """(doc key, item_id, distance): every item that a document holds, and its smallest distance in words."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, item_id long, distance long"
    result = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, item_key, item_text, share, recall=recall):

        def make(block=block):
            def work(batch, texts):
                found = block.find(texts)
                if not found:
                    return None
                text, item, distance = zip(*found)
                return pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(text)), pa.array([block.ids[i] for i in item], pa.int64()),
                     pa.array(distance, pa.int64())],
                    ["id", "item_id", "distance"],
                )

            return work

        result = result.unionByName(source.mapInArrow(per_slice(make, "text"), schema))
    return result.withColumnRenamed("id", key)


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item; a pass per block of items, no shuffle."""
    names = docs.columns
    for block in item_blocks(items, item_key, item_text):

        def make(block=block):
            def work(batch, texts):
                held = {t for t, _, _ in block.find(texts)}
                return batch.filter(pa.array([i not in held for i in range(len(batch))])) if held else batch

            return work

        docs = docs.mapInArrow(per_slice(make, text), docs.schema)
    return docs.select(*names)
