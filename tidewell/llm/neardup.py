"""Near duplicates of texts: BagMinHash signatures, banding, exact multiset overlap, classes.

A text is the multiset of its five-word shingles (words are runs of characters
other than space and 0x09-0x0D, case of A-Z ignored; a text of one to four words
is one shingle). Two texts are linked if sum(min) / sum(max) of their shingle
counts is at least the threshold; a class is a connected set of links, named by
its smallest id.

Signature: for each shingle with weight w, independent Poisson processes over the
weight intervals [0,1), [1,2), [2,4), [4,8), ... The points of an interval arrive at
its width as rate and are halved down into it; only points below w count. Each
point picks a component, a component keeps its earliest point, and a process is
followed only until it passes the latest of the text's components.

Defined results: a null text, a text without a word and a row without id are in
no class (``class_id`` is null). Equal texts always share a class; repeated rows
are repeated in the result. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tidewell.llm.arrays import find_words, flat, free_name, list_array, mix, per_slice, strings, word_hashes
from tidewell.llm.components import connected
from tidewell.session import discard, materialize

SHINGLE = 5
BANDS = 26
ROWS = 5
_HASH_BITS = np.uint64(48)
_LOW = np.uint64((1 << 48) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PART = mix(np.arange(1, 1 + max(SHINGLE, ROWS), dtype=np.uint64)) | np.uint64(1)


def shingle_counts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number << 48 | hash) of the distinct shingles, ascending; their counts; the words of each text."""
    starts, ends, first = find_words(data, bounds)
    hashes = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(len(hashes)) - first[text]
    begin = np.flatnonzero(place < np.maximum(n_words - SHINGLE + 1, 1)[text])
    owner = text[begin]
    total = np.zeros(len(begin), np.uint64)
    for k in range(SHINGLE):
        at = begin + k
        there = at < first[owner + 1]
        total += np.where(there, hashes[np.minimum(at, len(hashes) - 1)] * _PART[k], np.uint64(0))
    keys = (owner.astype(np.uint64) << _HASH_BITS) | (mix(total) & _LOW)
    keys.sort()
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.diff(np.append(edge, len(keys))), n_words


def bag_min_hash(keys: np.ndarray, counts: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """Signatures (n_texts x size) of weighted sets given as ``shingle_counts`` returns them."""
    best = np.full(n_texts * size, np.inf)
    points = np.zeros(n_texts * size, np.uint64)
    levels = [(0, 1)]
    while levels[-1][1] < counts.max(initial=0):
        levels.append((levels[-1][1], 2 * levels[-1][1]))
    text, seed, low, width, weight = [], [], [], [], []
    for number, (a, b) in enumerate(levels):
        has = counts > a
        text.append((keys[has] >> _HASH_BITS).astype(np.int64))
        seed.append(mix((keys[has] & _LOW) + np.uint64(number << 48)))
        low.append(np.full(len(text[-1]), a))
        width.append(np.full(len(text[-1]), b - a))
        weight.append(counts[has])
    text, seed, low, width, weight = map(np.concatenate, (text, seed, low, width, weight))
    time, drawn = np.zeros(len(text)), 0
    while len(text):
        ahead = int(np.clip(8192 // len(text), 1, 64))
        step = np.arange(drawn + 1, drawn + ahead + 1, dtype=np.uint64) * _STEP
        draw = mix(seed[:, None] + step)
        gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        arrival = time[:, None] + np.cumsum(gaps / width[:, None], axis=1)
        point = mix(draw + np.uint64(1))
        cell = text[:, None] * size + (point >> np.uint64(32)).astype(np.int64) % size
        kept = arrival < best[cell]
        if (width > 1).any():  # the leading bits halve the interval down to one unit of weight
            share = (point & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
            kept &= low[:, None] + np.floor(share * width[:, None]) < weight[:, None]
        cell, when, name = cell[kept], arrival[kept], point[kept]
        np.minimum.at(best, cell, when)
        first = best[cell] == when
        points[cell[first]] = name[first]
        last = best.reshape(n_texts, size).max(axis=1)
        time, drawn = arrival[:, -1], drawn + ahead
        open_ = time < last[text]
        if not open_.all():
            text, seed, low, width, weight, time = (x[open_] for x in (text, seed, low, width, weight, time))
    return points.reshape(n_texts, size)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket number per text and band."""
    parts = signatures.reshape(len(signatures), bands, rows)
    total = np.zeros(parts.shape[:2], np.uint64)
    for k in range(rows):
        total += mix(parts[:, :, k] + np.uint64(k)) * _PART[k]
    return mix(total + np.arange(bands, dtype=np.uint64) * _STEP).view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, digest, n_words, bands) of every row; digest and bands are null without an id or a word."""

    def make():
        def work(batch, texts):
            data, bounds = flat(texts)
            keys, counts, n_words = shingle_counts(data, bounds)
            found = band_keys(bag_min_hash(keys, counts, len(n_words), bands * rows), bands, rows)
            has = (n_words > 0) & np.asarray(batch.column("id").is_valid())
            raw = data.tobytes()
            digests = [
                hashlib.md5(raw[bounds[i] : bounds[i + 1]], usedforsecurity=False).digest() if has[i] else None
                for i in range(len(has))
            ]
            lists = list_array(found.ravel(), np.full(len(has), bands), pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(digests, pa.binary()), pa.array(n_words, pa.int64()),
                 pc.if_else(pa.array(has), lists, None)],
                ["id", "digest", "n_words", "bands"],
            )

        return work

    rows_in = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows_in.mapInArrow(per_slice(make, "text"), "id long, digest binary, n_words long, bands array<long>")


def overlaps(pairs: DataFrame) -> DataFrame:
    """(a, b, shared, total) of rows (a, b, text_a, text_b): sums of the smaller and of the larger shingle counts."""

    def run(batches):
        for batch in batches:
            left, right = strings(batch.column("text_a")), strings(batch.column("text_b"))
            for lo in range(0, len(batch), 256):
                n = min(256, len(batch) - lo)
                a, ca, _ = shingle_counts(*flat(left.slice(lo, n)))
                b, cb, _ = shingle_counts(*flat(right.slice(lo, n)))
                _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                owner = (a[ia] >> _HASH_BITS).astype(np.int64)
                shared = np.bincount(owner, np.minimum(ca[ia], cb[ib]), n).astype(np.int64)
                total = sum(
                    np.bincount((k >> _HASH_BITS).astype(np.int64), c, n).astype(np.int64) for k, c in ((a, ca), (b, cb))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").slice(lo, n), batch.column("b").slice(lo, n), pa.array(shared),
                     pa.array(total - shared)],
                    ["a", "b", "shared", "total"],
                )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, shared long, total long")


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose texts are at least ``percent`` alike."""
    left, right = texts.toDF("a", "text_a").hint("merge"), texts.toDF("b", "text_b").hint("merge")
    rows = pairs.join(left, "a").join(right, "b")  # one plan at every size; a hub that many meet is split
    return overlaps(rows).where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")


def _shared_buckets(texts: DataFrame) -> DataFrame:
    """(bucket, digest, n): the buckets that hold n > 1 texts, and who is in them."""
    members = texts.select("digest", F.explode("bands").alias("bucket"))
    sizes = materialize(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "neardup-sizes")
    shared = materialize(members.join(sizes, "bucket"), "neardup-shared")
    discard(sizes)
    return shared


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): every text of a bucket with its hub, the text that meets most others over all buckets (ties by digest).

    Such a text has fewest edits of its own, so it is the one that most of its group is linked to. A bucket of n
    texts gives n - 1 pairs, and most buckets of a group share their hub.
    """
    met = shared.groupBy("digest").agg(F.sum("n").alias("met"))
    hubs = shared.join(met, "digest").groupBy("bucket").agg(F.max(F.struct("met", "digest"))["digest"].alias("hub"))
    hubs = materialize(hubs, "neardup-hubs")
    pairs = shared.join(hubs, "bucket").where("digest <> hub").select(F.col("hub").alias("a"), F.col("digest").alias("b"))
    pairs = materialize(pairs.distinct(), "neardup-pairs")
    discard(hubs)
    return pairs


def shingle_rows(texts: DataFrame) -> DataFrame:
    """(digest, label, size, shingle, n) of every distinct shingle of rows (digest, label, text)."""

    def make():
        def work(batch, texts):
            keys, counts, n_words = shingle_counts(*flat(texts))
            owner = (keys >> _HASH_BITS).astype(np.int64)
            at = pa.array(owner)
            size = np.bincount(owner, counts, len(n_words)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column("digest").take(at), batch.column("label").take(at), pa.array(size[owner]),
                 pa.array((keys & _LOW).astype(np.int64)), pa.array(counts.astype(np.int64))],
                ["digest", "label", "size", "shingle", "n"],
            )

        return work

    schema = "digest binary, label binary, size long, shingle long, n long"
    return texts.select("digest", "label", "text").mapInArrow(per_slice(make, "text"), schema)


def _open_pairs(shingles: DataFrame, percent: int) -> DataFrame:
    """(a, b): texts of different labels that may still be alike, by an exact prefix filter.

    Texts of sizes x and y that are alike share at least x + y times percent / (100 + percent) shingles, so
    with the rarest shingles first they share one before place x (y) less that number. An edited copy spends
    that prefix on its own edits and so meets nobody. Per shingle, texts of the most frequent label are
    met by the others only, never by each other.
    """
    rarity = shingles.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    common = shingles.join(materialize(rarity, "neardup-rarity"), "shingle")
    order = W.partitionBy("digest").orderBy("held", "shingle")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = F.col("size") - F.sum("n").over(W.partitionBy("digest"))  # the shingles of no other text come first
    prefix = common.withColumn("place", before + own).where(F.col("place") * 100 <= F.col("size") * (100 - percent))
    prefix = materialize(prefix.select("shingle", "digest", "label", "size", "place"), "neardup-prefixes")
    each = prefix.groupBy("shingle", "label").agg(F.count("*").alias("k"))
    ruling = each.groupBy("shingle").agg(F.max(F.struct("k", "label"))["label"].alias("ruling"), F.count("*").alias("labels"))
    ruling = materialize(ruling.where("labels > 1").drop("labels"), "neardup-ruling")
    named = prefix.join(ruling, "shingle")
    a, b = (named.select("shingle", "ruling", *(F.col(c).alias(f"{c}_{s}") for c in ("digest", "label", "size", "place"))) for s in "ab")
    a = materialize(a.where("label_a <> ruling").drop("ruling"), "neardup-minor")
    both = F.col("size_a") + F.col("size_b")
    early = [F.col(f"place_{s}") * (100 + percent) <= F.col(f"size_{s}") * (100 + percent) - both * percent for s in "ab"]
    once = (F.col("label_b") == F.col("ruling")) | (F.col("digest_a") < F.col("digest_b"))
    pairs = a.join(b, "shingle").where((F.col("label_a") != F.col("label_b")) & early[0] & early[1] & once)
    return materialize(pairs.select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b")).distinct(), "neardup-open")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(key, digest, class_id, label, n_words) of every row of ``docs``; see the module for what a class is.

    Where an id has several texts, unlike classes may have the same ``class_id``; ``label`` tells them apart.

    Equal texts are folded first, so copies never meet. In each bucket every text is
    compared with a hub and classes are formed. Texts of one bucket that are then still in
    different classes are compared where an exact filter leaves it possible: texts that share
    a bucket end up linked, joined through others, or proven too different.
    """
    signed = materialize(signatures(docs, key, text, bands, rows), "neardup-signatures")
    texts = materialize(
        signed.where("digest is not null").groupBy("digest").agg(F.min("id").alias("id"), F.first("bands").alias("bands")),
        "neardup-texts",
    )
    shared = _shared_buckets(texts)
    pairs = _hub_pairs(shared)
    met = shared.select("digest").distinct().join(texts.select("digest", "id"), "digest")
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    same = F.unhex(F.md5(F.col("text").cast("binary"))) == F.col("digest")  # rows may share an id, not a text
    needed = source.join(materialize(met, "neardup-met").hint("merge"), "id").where(same).select("digest", "text")
    needed = materialize(needed.dropDuplicates(["digest"]), "neardup-needed")
    links = materialize(_links(pairs, needed, percent), "neardup-links")
    labels = connected(links)
    label = F.coalesce("label", "digest").alias("label")
    labelled = materialize(shared.join(labels, "digest", "left").select("bucket", "digest", label), "neardup-labelled")
    ends = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = labelled.join(ends.where("low < high"), "bucket", "left_semi").select("digest", "label").distinct()
    shingles = materialize(shingle_rows(needed.join(materialize(mixed, "neardup-mixed"), "digest")), "neardup-shingles")
    open_ = _open_pairs(shingles, percent)
    more = materialize(_links(open_, needed, percent), "neardup-more")
    if not more.isEmpty():
        labels = connected(links.union(more))
    named = texts.join(labels, "digest", "left").select("digest", "id", label)
    names = named.groupBy("label").agg(F.min("id").alias("class_id"))
    classes = materialize(named.join(names, "label").select("digest", "class_id", "label"), "neardup-classes")
    for table in (texts, shared, pairs, needed, links, labelled, shingles, open_, more):
        discard(table)
    found = signed.join(classes, "digest").select("id", "digest", "class_id", "label", "n_words")
    none = (F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("binary").alias("label"))
    alone = signed.where("digest is null").select("id", "digest", *none, "n_words")
    return found.unionByName(alone).withColumnRenamed("id", key)


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of its smallest id; rows of no class stay.

    Classes that share their smallest id each keep a row. Of rows that repeat an id and its text one stays.
    """
    classes = near_duplicates(docs.select(key, text), key, text)
    # a class may hold several texts under its smallest id: the smallest of them stays
    first = classes.where(F.col("class_id") == F.col(key)).groupBy("label", "class_id").agg(F.min("digest").alias("digest"))
    chosen = materialize(first.select(F.col("class_id").alias("id"), "digest"), "neardup-kept")
    mark = free_name(docs, "digest")
    wordless = F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True)) | F.col(key).isNull()
    marked = docs.where(~wordless).withColumn(mark, F.unhex(F.md5(F.col(text).cast("binary"))))
    same = (marked[key].cast("long") == chosen["id"]) & (marked[mark] == chosen["digest"])
    stay = marked.join(chosen, same, "left_semi").dropDuplicates([key, mark]).drop(mark)
    return stay.unionByName(docs.where(wordless))
