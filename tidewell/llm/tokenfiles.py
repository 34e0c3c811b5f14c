"""Token ids in binary blocks: patched frame of reference.

Documents are encoded with the tokenizers library, end with an end id, and are written in
ascending order of their key. A row of the written Parquet files is a run of whole
documents: their keys and numbers of ids, the number of ids in the file before the run,
and one binary body of blocks with the index of where each block starts.

A block holds up to 1,024 ids. Their minimum is subtracted; the bits of a high percentile of
the rest are the width at which all are packed; what does not fit is an exception, kept
as its position and its high part. A block: minimum (4 bytes), count (2), width (1), exceptions (2),
packed low bits, positions (2 each), high parts (4 each), all little-endian.

Files are numbered by their range of keys, so file number and place in it order all ids; the
ids before a document are those of earlier files, of earlier runs and of earlier
documents of its run.

Defined results: a null or empty text has its end id only; null keys come first; rows of equal key
are ordered by text and stay separate documents.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tidewell.llm.arrays import flat, slices, strings, word_hashes

BLOCK = 1024
RUN_IDS = 1 << 16
PERCENTILE = 0.95
REMEMBERED_BYTES = 32 << 20
LONGEST = 64
HEAD = np.dtype([("low", "<u4"), ("count", "<u2"), ("width", "u1"), ("exceptions", "<u2")])


def pack_block(ids: np.ndarray) -> bytes:
    """One block of up to BLOCK ids."""
    low = int(ids.min())
    rest = (ids - low).astype("<u4")
    at = int(np.ceil(PERCENTILE * len(rest))) - 1
    width = int(np.partition(rest, at)[at]).bit_length()
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    head = np.array((low, len(rest), width, len(over)), HEAD)
    return b"".join([
        head.tobytes(), np.packbits(bits, bitorder="little").tobytes(),
        over.astype("<u2").tobytes(), (rest[over] >> np.uint32(width)).astype("<u4").tobytes(),
    ])


def unpack_block(body: bytes, at: int) -> np.ndarray:
    """The ids of the block that starts at a byte."""
    head = np.frombuffer(body, HEAD, 1, at)[0]
    low, count, width, n_over = (int(head[f]) for f in HEAD.names)
    at += HEAD.itemsize
    n_bytes = -(-count * width // 8)
    bits = np.zeros((count, 32), np.uint8)
    packed = np.frombuffer(body, np.uint8, n_bytes, at)
    bits[:, :width] = np.unpackbits(packed, bitorder="little")[: count * width].reshape(count, width)
    rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    at += n_bytes
    where = np.frombuffer(body, "<u2", n_over, at)
    rest[where] |= np.frombuffer(body, "<u4", n_over, at + 2 * n_over) << np.uint32(width)
    return rest + np.uint32(low)


def pack(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """(body, start of each block)."""
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    return b"".join(blocks), starts.tolist()


def unpack(body: bytes, starts) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<u4"), *(unpack_block(body, int(s)) for s in starts)])


# How the bytes of a text split into words: blank, letter, digit, other. A digit is a word by itself.
_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_PLAIN_CLASS = np.full(256, _OTHER, np.uint8)
_PLAIN_CLASS[[10, 32]] = _BLANK
_PLAIN_CLASS[48:58] = _DIGIT
for _range in (range(65, 91), range(97, 123), range(128, 256)):
    _PLAIN_CLASS[_range.start:_range.stop] = _LETTER
# Texts with other bytes are cut at blanks only: control characters, apostrophes (contractions), and beyond ASCII
# all but the letters from U+00C0 to U+024F.
_ODD_BYTE = np.zeros(256, bool)
_ODD_BYTE[:32] = _ODD_BYTE[0xCA:] = _ODD_BYTE[0xC0:0xC3] = True
_ODD_BYTE[[39, 127]] = True
_ODD_BYTE[10] = False
# Two signs among these letters, and three letters whose lower case lies elsewhere.
_ODD_PAIRS = [b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0", b"\xc8\xba", b"\xc8\xbe"]
# Words that are one token group each when joined by blanks.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ȹȻ-Ƚȿ-ɏ]+")


class WordEncoder:
    """Ids of texts by the tokenizers library; each distinct word is encoded once and remembered.

    Right for vocabularies that lower the case, drop white space and mark the end of each word, as blanks
    then never share a token with a word. Words are found, hashed and looked up as arrays over the bytes of
    many texts; a hit is compared byte by byte. New words are encoded as one text; the end marks
    tell them apart again. What is remembered is bounded in bytes, and no word above ``LONGEST`` bytes is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.spelled, self.spelled_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.hashes = np.zeros(0, np.uint64)
        self.slots = np.full(1 << 16, -1, np.int32)

    def words(self, texts: pa.Array, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words whose ids one after the other are those of the texts, and each text's first word's number."""
        odd = _ODD_BYTE[data]
        at = np.flatnonzero(data == 0xC9)
        odd[at] |= data[at + 1] > 0x8F
        for pair in _ODD_PAIRS:
            at = np.flatnonzero(data == pair[0])
            odd[at] |= data[at + 1] == pair[1]
        strange = np.add.reduceat(np.append(odd, False), bounds[:-1], dtype=np.int64) > 0 if len(texts) else np.zeros(0, bool)
        strange &= np.diff(bounds) > 0
        for token in self.special:
            strange |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        kind = _PLAIN_CLASS[data]
        for t in np.flatnonzero(strange):
            own = kind[bounds[t] : bounds[t + 1]]
            own[own != _BLANK] = _LETTER
        change = np.ones(len(data) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        change[:-1] |= kind == _DIGIT
        change[1:] |= kind == _DIGIT
        change[bounds] = True
        filled = kind != _BLANK
        starts = np.flatnonzero(change[:-1] & filled)
        ends = np.flatnonzero(change[1:] & filled) + 1
        return starts, ends, np.searchsorted(starts, bounds)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each known word, -1 of others."""
        slot = (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64)
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            at = self.slots[slot[open_]]
            used = at >= 0
            open_, at = open_[used], at[used]
            hit = self.hashes[at] == hashes[open_]
            found[open_[hit]] = at[hit]
            open_ = open_[~hit]
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
        return found

    def learn(self, spelled: list[bytes], hashes: np.ndarray) -> None:
        """Remember words of different hashes."""
        order, ids, counts = self.encode_words([w.decode() for w in spelled])
        spelled, hashes = [spelled[i] for i in order], hashes[order]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.spelled = np.append(self.spelled, np.frombuffer(b"".join(spelled), np.uint8))
        self.spelled_at = np.append(self.spelled_at, self.spelled_at[-1] + np.cumsum(sizes))
        self.ids = np.append(self.ids, ids)
        self.ids_at = np.append(self.ids_at, self.ids_at[-1] + np.cumsum(counts))
        self.hashes = np.append(self.hashes, hashes)
        fresh = np.arange(len(self.hashes) - len(hashes), len(self.hashes))
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = np.full(1 << (4 * len(self.hashes)).bit_length(), -1, np.int32)
            fresh = np.arange(len(self.hashes))
        slot = (self.hashes[fresh] & np.uint64(len(self.slots) - 1)).astype(np.int64)
        while len(fresh):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = fresh[free]  # of several words for a place the last one has it
            left = self.slots[slot] != fresh
            fresh, slot = fresh[left], (slot[left] + 1) & (len(self.slots) - 1)

    def encode_words(self, words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(numbers of the words in the order of their ids, ids, number of ids of each)."""
        plain, rest = [], []
        for i, word in enumerate(words):
            (plain if LETTERS.fullmatch(word) else rest).append(i)
        (code,) = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in plain])], add_special_tokens=False)
        ids = np.array(code.ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(plain):
            plain, rest, ids, ends = [], [*plain, *rest], ids[:0], ends[:0]
        made = [code.ids for code in self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)]
        more = np.fromiter(chain.from_iterable(made), "<u4")
        return plain + rest, np.append(ids, more), np.append(np.diff(ends, prepend=0), list(map(len, made))).astype(np.int64)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id behind it, and the n + 1 bounds between texts."""
        data, bounds = flat(texts)
        starts, ends, first = self.words(texts, data, bounds)
        hashes = word_hashes(data, starts, ends, fold=False)
        short = ends - starts <= LONGEST
        found = self.find(hashes)
        fresh = np.flatnonzero((found < 0) & short)
        if len(fresh):
            new, at = np.unique(hashes[fresh], return_index=True)
            if self.spelled.nbytes + self.ids.nbytes + 24 * (len(self.hashes) + len(new)) > REMEMBERED_BYTES:
                self.forget()
                new, at = np.unique(hashes[short], return_index=True)
                fresh = np.flatnonzero(short)
            at = fresh[at]
            self.learn([data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist())], new)
            found = self.find(hashes)
        found[~short] = -1
        known = found >= 0
        known[known] = np.diff(self.spelled_at)[found[known]] == (ends - starts)[known]
        # compared by bytes: a word whose hash is another's is encoded by itself
        at = np.flatnonzero(known)
        lengths = (ends - starts)[at]
        unlike = data[spread(starts[at], lengths)] != self.spelled[spread(self.spelled_at[found[at]], lengths)]
        if unlike.any():
            known[at[np.unique(np.repeat(np.arange(len(at)), lengths)[unlike])]] = False
        pool, pool_at = self.ids, self.ids_at
        alone = np.flatnonzero(~known)
        if len(alone):
            spelled = [data[a:b].tobytes().decode() for a, b in zip(starts[alone].tolist(), ends[alone].tolist())]
            order, ids, counts = self.encode_words(spelled)
            found[alone[order]] = len(pool_at) - 1 + np.arange(len(alone))
            pool, pool_at = np.append(pool, ids), np.append(pool_at, pool_at[-1] + np.cumsum(counts))
        counts = np.diff(pool_at)[found]
        total = np.append(0, np.cumsum(counts))
        edges = total[first] + np.arange(len(bounds))
        out = np.full(edges[-1], end, "<u4")
        inside = np.ones(edges[-1], bool)
        inside[edges[1:] - 1] = False
        out[inside] = pool[spread(pool_at[found], counts)]
        return out, edges


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each stretch, one stretch after the other."""
    ahead = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - ahead, sizes)


@lru_cache(4)
def encoder(path: str) -> WordEncoder:
    """The encoder of a file, once per process; what it remembers goes when a task ends."""
    return WordEncoder(path)


RUNS = "file long, run long, before long, ids array<long>, sizes array<long>, starts array<long>, body binary"


def _write_runs(path: str, end: int):
    def run(batches):
        own = encoder(path)
        number = before = held = 0
        keys, sizes, parts, file = [], [], [], None

        def close():
            nonlocal number, before, held, keys, sizes, parts
            body, starts = pack(np.concatenate(parts))
            made = pa.RecordBatch.from_pydict(
                {"file": [file], "run": [number], "before": [before], "ids": [keys], "sizes": [sizes], "starts": [starts],
                 "body": [body]},
                pa.schema([("file", pa.int64()), ("run", pa.int64()), ("before", pa.int64()), ("ids", pa.list_(pa.int64())),
                           ("sizes", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("body", pa.binary())]),
            )
            number, before = number + 1, before + held
            held, keys, sizes, parts = 0, [], [], []
            return made

        try:
            for batch in batches:
                texts = strings(batch.column("text"))
                file = batch.column("file")[0].as_py()
                for lo, hi in slices(texts):
                    codes, edges = own.encode(texts.slice(lo, hi - lo), end)
                    ids = batch.column("id").slice(lo, hi - lo).to_pylist()
                    for key, a, b in zip(ids, edges.tolist(), edges[1:].tolist()):
                        keys.append(key)
                        sizes.append(b - a)
                        parts.append(codes[a:b])
                        held += b - a
                        if held >= RUN_IDS:
                            yield close()
            if keys:
                yield close()
        finally:
            own.forget()

    return run


def write_token_files(docs: DataFrame, path: str, out: str, key: str = "doc_id", text: str = "text", end: int = 2) -> None:
    """Encode all rows and write the files to ``out``, ranges of ascending keys in files of ascending number."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # a beginning of the text as second key lets an id with very many rows be several ranges
    ranges = F.col("id").asc_nulls_first(), F.substring("text", 1, 32).asc_nulls_first()
    ordered = rows.repartitionByRange(n, *ranges).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    numbered = ordered.withColumn("file", F.spark_partition_id().cast("long"))
    numbered.mapInArrow(_write_runs(path, end), RUNS).write.parquet(out)


def read_runs(spark, out: str) -> DataFrame:
    """The written runs; ``before`` counts all ids ahead of a run, those of earlier files included."""
    runs = spark.read.parquet(out)
    files = runs.groupBy("file").agg(F.sum(F.col("before") * 0 + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    order = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    offsets = files.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ahead"))
    # a row per file, of which there are as many as shuffle partitions
    return runs.join(F.broadcast(offsets), "file").withColumn("before", F.col("before") + F.col("ahead")).drop("ahead")


def read_documents(runs: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids) of every document, ids as little-endian unsigned 32-bit integers."""
    return _read(runs, "ids binary", pa.binary(), "ids", lambda raw: raw)


def document_checks(runs: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, computed from the unpacked blocks."""
    return _read(runs, "ids_crc32 long", pa.int64(), "ids_crc32", zlib.crc32)


def _read(runs, field, kind, name, shape):
    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                get = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
                ids = unpack(get("body"), get("starts"))
                sizes = np.array(get("sizes"), np.int64)
                ends = np.cumsum(sizes)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a run holds other ids than its index says")
                values = [shape(ids[e - s : e].tobytes()) for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, pa.array(get("before") + ends - sizes), pa.array(sizes),
                     pa.array(values, kind)],
                    ["id", "start", "n_tokens", name],
                )

    columns = runs.select("before", "ids", "sizes", "starts", "body")
    return columns.mapInArrow(run, f"id long, start long, n_tokens long, {field}")
