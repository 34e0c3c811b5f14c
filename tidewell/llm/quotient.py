"""Exact duplicates: counting quotient filters per partition, merged by sorted remainders, then compared byte by byte.

* Fingerprints. A text is normalised (runs of white space become one space) and hashed to ``bits`` bits.
* Filter. The high bits of a fingerprint are its quotient, its home slot; the low bits are the remainder stored there.
  Remainders of one quotient form a sorted run; runs are shifted to the right where they would overlap. Three bits a
  slot tell which quotients have a run, where runs end, and which slots hold digits of a counter: a remainder that
  occurs c > 1 times is followed by the digits of c - 1.
* Merge. A task builds filters of at most ``FILTER_ROWS`` fingerprints and cuts them into ranges of leading bits. One task
  merges a range: a filter lists its fingerprints in order, so sorted lists are added up and nothing is lost. The number of
  ranges follows from the number of rows, so that a range holds about ``RANGE_ROWS`` of them at any size.
* Verification. Only texts whose fingerprint was counted twice or more are compared, as whole texts. Fingerprints that
  unlike texts share are told apart by the text itself.

Fingerprints of more than one row in ``HOT_SHARE`` are fewer than ``HOT_SHARE``; these are sent to all tasks, where their
rows are folded before any shuffle. All other groups are joined by fingerprint.

Defined results: a null text is empty; of equal texts the smallest key stays, null keys last, and one row among rows of
equal key; an empty table gives an empty result.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.session import discard, materialize

BITS = 64
FILTER_ROWS = 1 << 20
RANGE_ROWS = 1 << 15
HOT_SHARE = 1024
SPACE = r"[\x20\x09-\x0D]+"
_HEAD = struct.Struct("<BBq")


def _low_bits(n: int) -> np.uint64:
    return np.uint64((1 << n) - 1)


def build(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of ascending distinct fingerprints of ``bits`` bits with their counts."""
    n = len(fingerprints)
    q = min(bits, max(1, (n + n // 4).bit_length()))
    r = bits - q
    width = max(1, -(-r // 8))
    quotient = (fingerprints >> np.uint64(r)).astype(np.int64)
    more = counts.astype(np.uint64) - np.uint64(1)
    digits = np.zeros(n, np.int64)
    rest = more.copy()
    while rest.any():
        digits += rest > 0
        rest = rest >> np.uint64(8 * width) if width < 8 else np.zeros_like(rest)
    heads = np.flatnonzero(np.append(True, quotient[1:] != quotient[:-1])) if n else np.zeros(0, np.int64)
    lengths = np.add.reduceat(1 + digits, heads) if n else heads
    before = np.cumsum(lengths) - lengths
    starts = before + np.maximum.accumulate(quotient[heads] - before) if n else heads
    slots = max(1 << q, int(starts[-1] + lengths[-1]) if n else 0)
    occupied, ends, counting = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
    occupied[quotient[heads]] = True
    ends[starts + lengths - 1] = True
    offset = np.cumsum(1 + digits) - (1 + digits)
    run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    place = starts[run] + offset - before[run]
    cells = np.zeros(slots, np.uint64)
    cells[place] = fingerprints & _low_bits(r)
    for digit in range(int(digits.max(initial=0))):
        having = np.flatnonzero(digits > digit)
        at = place[having] + 1 + digit
        counting[at] = True
        cells[at] = (more[having] >> np.uint64(8 * width * digit)) & _low_bits(8 * width)
    packed = np.ascontiguousarray(cells).view(np.uint8).reshape(slots, 8)[:, :width]
    flags = (np.packbits(x).tobytes() for x in (occupied, ends, counting))
    return _HEAD.pack(bits, q, slots) + b"".join(flags) + packed.tobytes()


def listed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter in ascending order, and their counts."""
    bits, q, slots = _HEAD.unpack_from(blob)
    r = bits - q
    width = max(1, -(-r // 8))
    at = _HEAD.size
    flags = []
    for size in (1 << q, slots, slots):
        packed = np.frombuffer(blob, np.uint8, -(-size // 8), at)
        flags.append(np.unpackbits(packed, count=size).astype(bool))
        at += len(packed)
    cells = np.zeros((slots, 8), np.uint8)
    cells[:, :width] = np.frombuffer(blob, np.uint8, slots * width, at).reshape(slots, width)
    cells = cells.view(np.uint64).ravel()
    quotient, end = np.flatnonzero(flags[0]), np.flatnonzero(flags[1])
    if not len(quotient):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start = np.maximum(quotient, np.append(0, end[:-1] + 1))
    lengths = end - start + 1
    run = np.repeat(np.arange(len(end)), lengths)
    place = start[run] + np.arange(len(run)) - (np.cumsum(lengths) - lengths)[run]
    digit = flags[2][place]
    head = np.flatnonzero(~digit)
    fingerprints = quotient[run[head]].astype(np.uint64) << np.uint64(r) | cells[place[head]]
    counts = np.ones(len(head), np.uint64)
    owner = np.cumsum(~digit) - 1
    later = np.flatnonzero(digit)
    weight = (later - head[owner[later]] - 1) * (8 * width)
    np.add.at(counts, owner[later], cells[place[later]] << weight.astype(np.uint64))
    return fingerprints, counts.astype(np.int64)


def merged(blobs: list[bytes], bits: int) -> bytes:
    """One filter with the fingerprints of all, their counts added."""
    parts = [listed(blob) for blob in blobs]
    every = np.concatenate([part[0] for part in parts])
    counts = np.concatenate([part[1] for part in parts])
    order = np.argsort(every, kind="stable")  # ascending runs are merged
    every, counts = every[order], counts[order]
    heads = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    return build(every[heads], np.add.reduceat(counts, heads), bits)


def range_bits(rows: int, bits: int = BITS) -> int:
    """Leading bits that cut so many rows into ranges of about RANGE_ROWS."""
    return min(bits - 1, max(0, (rows // RANGE_ROWS).bit_length()))


def partition_filters(fingerprints: DataFrame, cut: int, bits: int = BITS) -> DataFrame:
    """(part, filter) of every partition of (fp): its filters, cut into 2**cut ranges."""

    def emitted(values: list[np.ndarray]) -> pa.RecordBatch:
        every, counts = np.unique(np.concatenate(values), return_counts=True)
        part = (every >> np.uint64(bits - cut)).astype(np.int64) if cut else np.zeros(len(every), np.int64)
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        bounds = np.append(heads, len(every))
        low = every & _low_bits(bits - cut)
        blobs = [build(low[a:b], counts[a:b], bits - cut) for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[heads]), pa.array(blobs, pa.binary())], ["part", "filter"])

    def run(batches):
        values, n = [], 0
        for batch in batches:
            for lo in range(0, len(batch), FILTER_ROWS):
                some = batch.column(0).slice(lo, FILTER_ROWS).to_numpy(zero_copy_only=False).view(np.uint64)
                if n and n + len(some) > FILTER_ROWS:
                    yield emitted(values)
                    values, n = [], 0
                values.append(some)
                n += len(some)
        if n:
            yield emitted(values)

    return fingerprints.select("fp").mapInArrow(run, "part long, filter binary")


def merge_filters(filters: DataFrame, cut: int, bits: int = BITS) -> DataFrame:
    """(part, filter) with one filter for each range."""

    def run(key, rows):
        return pd.DataFrame({"part": [key[0]], "filter": [merged(list(rows["filter"]), bits - cut)]})

    return filters.groupBy("part").applyInPandas(run, "part long, filter binary")


def repeated(filters: DataFrame, cut: int, bits: int = BITS) -> DataFrame:
    """(fp, n) of all fingerprints that were counted more than once."""

    def run(batches):
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("filter").to_pylist()):
                low, counts = listed(blob)
                often = counts > 1
                high = np.uint64(part << (bits - cut))
                found = (low[often] | high).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[often])], ["fp", "n"])

    return filters.mapInArrow(run, "fp long, n long")


def _stored(docs: DataFrame, key: str, text: str, bits: int, others: list[Column]) -> DataFrame:
    """The rows with a number, the normalised text and its fingerprint."""
    plain = F.regexp_replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), SPACE, " ")
    rest = [F.struct(*others).alias("rest")] if others else []
    rows = docs.select(F.col(f"`{key}`").alias("id"), plain.alias("text"), *rest)
    fingerprint = F.shiftrightunsigned(F.xxhash64("text"), 64 - bits).alias("fp")
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), fingerprint, "*"), "exact-rows")


def _first() -> list[Column]:
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    return [smallest, F.count("*").alias("n")]


def _decisions(stored: DataFrame, bits: int) -> DataFrame:
    """(row, id, keep_row, keep_id, n, sha) of every stored row."""
    total = stored.count()
    cut = range_bits(total, bits)
    parts = materialize(partition_filters(stored, cut, bits), "exact-filters")
    often = materialize(repeated(merge_filters(parts, cut, bits), cut, bits), "exact-repeated")
    discard(parts)
    is_hot = F.col("n") * F.lit(HOT_SHARE) > F.lit(total)
    hot, rest = often.where(is_hot).select("fp"), often.where(~is_hot).select("fp")
    hot = F.broadcast(hot)  # fewer than HOT_SHARE rows

    def members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return rows.join(hot, "fp"), rows.join(hot, "fp", "left_anti").join(rest, "fp", "left_semi")

    compared = [rows.groupBy("fp", "text").count() for rows in members(stored.select("fp", "text"))]
    verified = materialize(
        compared[0].groupBy("fp").agg(F.count("*").alias("texts"), F.lit(True).alias("hot")).unionByName(
            compared[1].groupBy("fp").agg(F.count("*").alias("texts"), F.lit(False).alias("hot"))
        ), "exact-verified",
    )
    discard(often)
    small = stored.select("row", "id", "fp", F.sha2("text", 256).alias("sha"))
    columns = ["row", "id", "first", "n", "sha"]
    alike = verified.where("texts = 1")
    hot_fp, cold_fp = F.broadcast(alike.where("hot").select("fp")), alike.where("not hot").select("fp")
    narrow = stored.select("row", "id", "fp")
    hot_first = narrow.join(hot_fp, "fp").groupBy("fp").agg(*_first())
    cold_first = narrow.join(hot_fp, "fp", "left_anti").join(cold_fp, "fp", "left_semi").groupBy("fp").agg(*_first())
    out = small.join(F.broadcast(hot_first), "fp").select(columns)
    others = small.join(hot_fp, "fp", "left_anti")
    mixed = verified.where("texts > 1").select("fp")
    if not mixed.isEmpty():  # unlike texts of one fingerprint: grouped by their bytes
        whole = stored.join(mixed, "fp", "left_semi").withColumn("sha", F.sha2("text", 256))
        firsts = whole.groupBy("fp", "text").agg(*_first())
        out = out.unionByName(whole.join(firsts, ["fp", "text"]).select(columns))
        others = others.join(mixed, "fp", "left_anti")
    out = out.unionByName(others.join(cold_first, "fp", "left").select(columns))
    return out.select(
        "row", "id", F.coalesce("first.row", "row").alias("keep_row"),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("n"), "sha",
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Every row: (key, keep_id, group_size, kept, text_sha256). ``bits`` below 64 only makes collisions likelier."""
    found = _decisions(_stored(docs, key, text, bits, []), bits)
    return found.select(
        F.col("id").alias(key), "keep_id", F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row of each group of equal texts, with all its columns as they were."""
    stored = _stored(docs, key, text, bits, [F.col(f"`{name}`") for name in docs.columns])
    kept = _decisions(stored, bits).where("row = keep_row").select("row")
    return stored.join(kept, "row", "left_semi").select("rest.*")


def corpus_filter(docs: DataFrame, text: str = "text", cut: int = 0, bits: int = BITS) -> DataFrame:
    """(part, filter) of a whole corpus, to be kept and merged with the filters of others by ``merge_filters``."""
    plain = F.regexp_replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), SPACE, " ")
    hashed = docs.select(F.shiftrightunsigned(F.xxhash64(plain), 64 - bits).alias("fp"))
    return merge_filters(partition_filters(hashed, cut, bits), cut, bits)
