"""Phrases whose words stand together more often than apart: suffix pointers sorted by multikey three-way quicksort.

* Words. A slice of texts numbers its distinct words; beyond the slice a word is a seeded 64-bit hash of language and word.
  The dictionary is kept: if two words ever shared a hash, all is done again with another seed.
* Routing. Each place of a piece is a pointer to the up to ``DEPTH`` words that follow. Equal pointers of a slice are folded,
  and pointers are dealt to buckets by their first two words, so that all places of a phrase meet. A language has buckets of its
  own, as many as its words need.
* Sorting. A bucket is sorted by multikey quicksort: pointers are parted into less, equal and greater by the word at the current
  depth, equal ones go on at the next depth, down to ``DEPTH``. The size of an equal part is the number of occurrences of its
  phrase. A part below the smallest frequency is abandoned at once. All parts of a round are parted together.
* Hot beginnings. A bucket of more than ``LIMIT`` pointers is dealt out again by three words, and, where that is not enough, its
  phrases are added up by Spark with partial sums. Sums of such parts are added before they are judged, so nothing is lost.
* Scores, cuts and the dropping of parts of longer phrases are joins and exact decimal arithmetic.

Defined results: null texts are empty; a null language is ``und``; languages without a candidate have no rows; repeated rows
count each time; an empty table gives an empty result. Frequencies below 1 are not asked for.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.llm.arrays import FOLD, find_words, flat, list_array, mix, slices, strings
from tidewell.session import discard, materialize

DEPTH = 4
LEAST = 30
TOP = 2000
CAPACITY = 3 << 19
LIMIT = 3 * CAPACITY
SLICE = 6 << 20
BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
INSIDE = ~BREAKS
INSIDE[[9, 32]] = False
_HEAD = struct.Struct("<IIBB")
ROUTED = "bucket long, size long, data binary"


def _pack(hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Pointers of one bucket: the ascending hashes of their words, the numbers of the words (0: none) by depth, and how
    often each is there. Of hashes and first words the differences are stored, hashes by byte."""
    kinds = [np.min_scalar_type(len(hashes)), np.min_scalar_type(int(counts.max(initial=0)))]
    columns = ids.T.astype(kinds[0])
    columns[0, 1:] = np.diff(columns[0])
    head = _HEAD.pack(len(hashes), len(ids), kinds[0].itemsize, kinds[1].itemsize)
    steps = np.diff(hashes, prepend=np.uint64(0))
    body = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + columns.tobytes() + counts.astype(kinds[1]).tobytes()
    return head + pa.compress(body, "zstd", asbytes=True)


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (the first stands for none), numbers and counts of the pointers of several rows."""
    parts = []
    for blob in blobs:
        words, n, id_size, count_size = _HEAD.unpack_from(blob)
        body = pa.decompress(blob[_HEAD.size :], 8 * words + (id_size * DEPTH + count_size) * n, "zstd")
        steps = np.frombuffer(body, np.uint8, 8 * words).reshape(8, words).T.copy().view(np.uint64).ravel()
        hashes = np.cumsum(steps, dtype=np.uint64)
        columns = np.frombuffer(body, f"u{id_size}", n * DEPTH, 8 * words).reshape(DEPTH, n).copy()
        np.cumsum(columns[0], out=columns[0], dtype=columns.dtype)
        counts = np.frombuffer(body, f"u{count_size}", n, 8 * words + id_size * n * DEPTH).copy()
        parts.append((hashes, columns.T, counts))
    every, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    offsets = np.cumsum([0] + [len(p[0]) for p in parts])
    ids = np.empty((sum(len(p[1]) for p in parts), DEPTH), np.int32)
    at = 0
    for (_, own, _), a, b in zip(parts, offsets[:-1], offsets[1:]):
        ids[at : at + len(own)] = np.append(0, place[a:b] + 1).astype(np.int32)[own]
        at += len(own)
    return np.append(np.uint64(0), every), ids, np.concatenate([p[2] for p in parts])


def _numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the number + 1 of every word in order, and whether the next word stands in the same piece."""
    data, bounds = flat(texts)
    data = FOLD[data]
    starts, ends, first = find_words(data, bounds, INSIDE)
    if not len(starts):
        return [], np.zeros(0, np.int32), np.zeros(0, bool)
    offsets = np.append(0, np.cumsum(ends - starts))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[INSIDE[data]])])
    coded = words.dictionary_encode()
    piece = np.cumsum(BREAKS[data], dtype=np.int32)[starts]
    new = np.zeros(len(starts) + 1, bool)
    new[first] = True
    joined = np.append((piece[1:] == piece[:-1]) & ~new[1:-1], False)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy() + np.int32(1), joined


def _folded(number: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pointers of two and more words (numbers, 0: none), sorted, with counts. A word of number 0 ends a pointer."""
    columns = [number]
    for _ in range(DEPTH - 1):
        columns.append(np.where(joined & (columns[0] > 0), np.append(columns[-1][1:], np.int32(0)), np.int32(0)))
    some = columns[1] > 0
    columns = [c[some] for c in columns]
    if number.max(initial=0) < 1 << 16:
        key = columns[0].astype(np.uint64)
        for column in columns[1:]:
            key = key << np.uint64(16) | column.astype(np.uint64)
        key, times = np.unique(key, return_counts=True)
        return np.column_stack([(key >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int32) for k in range(DEPTH - 1, -1, -1)]), times
    halves = [columns[k].astype(np.uint64) << np.uint64(32) | columns[k + 1].astype(np.uint64) for k in (0, 2)]
    (front, at_front), (back, at_back) = (np.unique(half, return_inverse=True) for half in halves)
    key, times = np.unique(at_front * max(1, len(back)) + at_back, return_counts=True)
    pair = (front[key // max(1, len(back))], back[key % max(1, len(back))])
    return np.column_stack([x for p in pair for x in ((p >> np.uint64(32)).astype(np.int32), p.astype(np.uint32).astype(np.int32))]), times


def _dealt(hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray, words: int, buckets: int):
    """(buckets, sizes, packed rows) of pointers dealt by the hash of their first ``words`` words."""
    at = np.zeros(len(ids), np.uint64)
    for column in range(words):
        at = mix(at ^ hashes[ids[:, column]])
    bucket = (at % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, ids, counts = bucket[order], ids[order], counts[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
    sizes = np.diff(np.append(heads, len(bucket)))
    rows = []
    for head, size in zip(heads.tolist(), sizes.tolist()):
        some = ids[head : head + size]
        if some.size > len(hashes):
            there = np.zeros(len(hashes), bool)
            there[some] = True
            there[0] = False
            used, local = np.flatnonzero(there), np.cumsum(there)[some]
            local[some == 0] = 0
        else:
            used = np.unique(some)
            local = np.searchsorted(used, some)
            if used[0] == 0:
                used = used[1:]
            else:
                local += 1
        rows.append(_pack(hashes[used], local, counts[head : head + size]))
    return bucket[heads], sizes, rows


def _hashes(words: list[bytes], lang: str, seed: int) -> np.ndarray:
    """A hash other than 0 for each word of a language."""
    own = xxhash.xxh64_intdigest(lang.encode(), seed)
    return np.maximum(np.fromiter((xxhash.xxh64_intdigest(w, own) for w in words), np.uint64, len(words)), np.uint64(1))


def _each_slice(docs: DataFrame, text: str, lang: str, seed: int, work, schema: str) -> DataFrame:
    """``work(language, words, hashes, numbers, joined)`` for every slice of the texts of one language in a batch."""

    def run(batches):
        for batch in batches:
            texts, langs = strings(batch.column(0)), strings(batch.column(1))
            for name in pc.unique(langs).to_pylist():
                own = texts.filter(pc.equal(langs, name))
                for lo, hi in slices(own, SLICE):
                    words, number, joined = _numbered(own.slice(lo, hi - lo))
                    yield work(name, words, _hashes(words, name, seed), number, joined)

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, schema)


def _dictionary(docs: DataFrame, text: str, lang: str, seed: int) -> DataFrame:
    """(hash, lang, word, n) of all words."""

    def counted(name, words, hashes, number, joined):
        counts = np.bincount(number, minlength=len(words) + 1)[1:]
        columns = [pa.array(hashes.view(np.int64)), pa.array([name] * len(words), pa.string()),
                   pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["hash", "lang", "word", "n"])

    rows = _each_slice(docs, text, lang, seed, counted, "hash long, lang string, word string, n long")
    return rows.groupBy("hash", "lang", "word").agg(F.sum("n").alias("n"))


def _route(docs: DataFrame, text: str, lang: str, seed: int, buckets: dict[str, tuple[int, int]]) -> DataFrame:
    """(bucket, size, data): the pointers of each slice. ``buckets`` has first bucket and number of a language, or of "" for others."""

    def dealt(name, words, hashes, number, joined):
        order = np.argsort(hashes)
        rank = np.empty(len(order) + 1, np.int32)
        rank[0], rank[order + 1] = 0, np.arange(1, len(order) + 1)
        ids, times = _folded(rank[number], joined)
        first, n = buckets.get(name, buckets[""])
        bucket, sizes, rows = _dealt(np.append(np.uint64(0), hashes[order]), ids, times, 2, n)
        return _batch(bucket + first, sizes, rows)

    return _each_slice(docs, text, lang, seed, dealt, ROUTED)


def _shares(words: DataFrame, capacity: int) -> dict[str, tuple[int, int]]:
    """Buckets for each language of more than ``capacity`` words, of which there are fewer than all words / capacity, and for the rest."""
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    is_large = F.col("n") > capacity
    large = {row["lang"]: row["n"] // capacity + 1 for row in sizes.where(is_large).collect()}
    large[""] = (sizes.where(~is_large).agg(F.sum("n")).first()[0] or 0) // capacity + 1
    ends = np.cumsum(list(large.values())).tolist()
    return {name: (end - n, n) for (name, n), end in zip(large.items(), ends)}


def _batch(bucket: np.ndarray, sizes: np.ndarray, rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())],
                                      ["bucket", "size", "data"])


def equal_parts(keys: np.ndarray, weights: np.ndarray, least: list[int]):
    """Multikey three-way quicksort of the rows of ``keys`` (0: no further word), all parts of a round at once.

    Yields (length, a row of each part, weight of each part) of the equal parts whose weight is ``least[length - 1]`` or more;
    lighter parts are not followed.
    """
    pointer = np.arange(len(keys), dtype=np.int32)  # a bucket has few enough
    size = np.array([len(keys)] if len(keys) else [], np.int64)
    depth = np.zeros(len(size), np.int64)
    floor = np.array(least)
    while len(size):
        start = np.cumsum(size) - size
        pivot = keys[pointer[start + size // 2], depth]
        part = np.repeat(np.arange(len(size), dtype=np.int32), size)
        word, middle = keys[pointer, depth[part]], pivot[part]
        side = (word >= middle).astype(np.int8) + (word > middle)
        del word, middle
        count = np.bincount(part * 3 + side, minlength=3 * len(size))
        begin = np.cumsum(count) - count
        moved = np.empty_like(pointer)
        for k in range(3):
            here = np.flatnonzero(side == k)
            owner = part[here]
            before = np.cumsum(count[k::3]) - count[k::3]
            moved[begin[owner * 3 + k] + np.arange(len(here)) - before[owner]] = pointer[here]
        some = np.flatnonzero(count)
        weight = np.add.reduceat(weights[moved], begin[some], dtype=np.int64)
        of, side = some // 3, some % 3
        level = depth[of]
        keep = weight >= floor[level]
        equal = keep & (side == 1) & (pivot[of] > 0)
        for length in np.unique(level[equal]) + 1:
            at = equal & (level == length - 1)
            yield length, moved[begin[some[at]]], weight[at]
        deeper = level + (side == 1)
        keep &= ((side != 1) | (pivot[of] > 0)) & (deeper < keys.shape[1])
        stay = np.repeat(keep, count[some])
        pointer, size, depth = moved[stay], count[some][keep], deeper[keep]


def _phrases(hashes: np.ndarray, ids: np.ndarray, found) -> pa.RecordBatch:
    """(p, f) of (length, row, weight) groups."""
    values, lengths, weights = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length, row, weight in found:
        if length > 1:  # single words are counted in the dictionary
            values.append(hashes[ids[row, :length]].ravel())
            lengths.append(np.full(len(row), length))
            weights.append(weight)
    p = list_array(np.concatenate(values).view(np.int64), np.concatenate(lengths), pa.int64())
    return pa.RecordBatch.from_arrays([p, pa.array(np.concatenate(weights), pa.int64())], ["p", "f"])


def _sorted_counts(routed: DataFrame, least: int, words: int) -> DataFrame:
    """(p, f) of the buckets: phrases of ``words`` words and more if frequent, shorter ones (2 and more words) as partial sums."""
    floors = [least] * DEPTH if words <= 2 else [1] * (words - 1) + [least] * (DEPTH - words + 1)

    def run(table: pa.Table) -> pa.Table:
        hashes, ids, counts = _unpack(table.column("data").to_pylist())
        return pa.Table.from_batches([_phrases(hashes, ids, equal_parts(ids, counts, floors))])

    return routed.select("bucket", "data").groupBy("bucket").applyInArrow(run, "p array<long>, f long")


def _deeper(routed: DataFrame, words: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for blob in batch.column("data").to_pylist():
                yield _batch(*_dealt(*_unpack([blob]), words, buckets))

    return routed.select("data").mapInArrow(run, ROUTED)


def _added_up(routed: DataFrame) -> DataFrame:
    """(p, f): partial sums of every phrase, without sorting whole buckets."""

    def run(batches):
        for batch in batches:
            for blob in batch.column("data").to_pylist():
                hashes, ids, counts = _unpack([blob])
                yield _phrases(hashes, ids, equal_parts(ids, counts, [1] * DEPTH))

    return routed.select("data").mapInArrow(run, "p array<long>, f long")


def count_phrases(routed: DataFrame, least: int = LEAST, capacity: int = CAPACITY, limit: int = LIMIT) -> DataFrame:
    """(p, f): the hashes and occurrences of all phrases of 2 to DEPTH words found ``least`` times."""
    rows, parts = routed, []
    for words in (2, 3):
        sizes = rows.groupBy("bucket").agg(F.sum("size").alias("pointers"))
        large = materialize(sizes.where(F.col("pointers") > limit), "large-buckets")
        pointers = large.agg(F.sum("pointers")).first()[0]
        if pointers is None:
            parts.append(_sorted_counts(rows, least, words))
            break
        parts.append(_sorted_counts(rows.join(large, "bucket", "left_anti"), least, words))
        hot = rows.join(large, "bucket", "left_semi")
        if words == 2:
            rows = materialize(_deeper(hot, 3, pointers // capacity + 1), "routed-by-three")
        else:
            parts.append(_added_up(hot))
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("p").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _wide(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def _judged(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, p, a, l, r, score) of the candidates that are no part of a longer one."""
    known = phrases.select("p", "f", F.lit(None).cast("string").alias("lang")).unionByName(
        words.select(F.array("hash").alias("p"), F.col("n").alias("f"), "lang")
    )
    size = F.size("p")
    cuts = phrases.select("p", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("left"),
                       F.slice("p", F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(known.select(F.col("p").alias("left"), F.col("f").alias("l"), "lang"), "left")
    cuts = cuts.join(known.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cuts = cuts.select("p", "a", "lang", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    best = cuts.groupBy("p", "a").agg(F.min("cut").alias("cut"), F.max("lang").alias("lang"))
    spans = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
            F.sequence(F.lit(1), size - m + 1), lambda at: F.slice("p", at, m)))),
        lambda x: F.size(x) > 1,
    )
    longer = phrases.where(size > 2).select(F.explode(spans).alias("p"), "f").groupBy("p").agg(F.max("f").alias("longest"))
    judged = best.join(longer, "p", "left")
    part = F.coalesce(_wide(F.col("longest")) * 100 >= _wide(F.col("a")) * 80, F.lit(False))
    return judged.where(~part).select("lang", "p", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
    capacity: int = CAPACITY, limit: int = LIMIT,
) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score), score = 2,000,000 a / (l + r)
    at its lowest cut, rounded down."""
    seed = 0
    while True:
        words = materialize(_dictionary(docs, text, lang, seed), "phrase-words")
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            break
        seed += 1
    frequent = words.where(F.col("n") >= least)
    routed = materialize(_route(docs, text, lang, seed, _shares(words, capacity)), "routed")
    phrases = materialize(count_phrases(routed, least, capacity, limit), "phrase-counts")
    discard(routed)
    judged = materialize(_judged(frequent, phrases), "phrase-scores")
    by_value = [F.desc("score"), F.desc("a")]
    # with all ties, so that the spelling decides among these only
    best = judged.withColumn("place", F.rank().over(W.partitionBy("lang").orderBy(*by_value))).where(F.col("place") <= top)
    best = materialize(best.drop("place"), "phrase-best")
    spelt = best.select("p", F.posexplode("p").alias("at", "hash")).join(frequent.select("hash", "word"), "hash")
    spelt = spelt.groupBy("p").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    total = materialize(words.groupBy("lang").agg(F.sum("n").alias("n")), "language-words")
    order = F.row_number().over(W.partitionBy("lang").orderBy(*by_value, "phrase"))
    ranked = best.join(spelt, "p").withColumn("rank", order.cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
