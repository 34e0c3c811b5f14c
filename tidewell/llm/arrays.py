"""Texts of an Arrow batch as flat byte arrays: words, hashes, slices of bounded size."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
NOT_WHITE = ~WHITE
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
ALNUM = np.zeros(256, bool)
for _range in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    ALNUM[_range.start:_range.stop] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_FOLDED = _BYTE[FOLD]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, kept per process for usual slices."""
    if len(_powers[0]) > n:
        return _powers[0], _powers[1]
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 4 * SLICE_BYTES:
        _powers[:] = made
    return made[0], made[1]


def strings(column) -> pa.Array:
    """The column as one array without nulls (null counts as empty) and with wide offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 bounds between them."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 16_384) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one longer text."""
    _, bounds = flat(texts)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        to = min(max(to, at + 1), at + rows, len(texts))
        yield at, to
        at = to


def find_words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray = NOT_WHITE):
    """Starts and ends of maximal runs of ``inside`` bytes in each text, and per text its first word's number."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    mask = inside[data]
    filled = bounds[:-1] < bounds[1:]
    before = np.empty_like(mask)
    before[1:] = mask[:-1]
    before[bounds[:-1][filled]] = False
    after = np.empty_like(mask)
    after[:-1] = mask[1:]
    after[bounds[1:][filled] - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


# Letters of scripts written without spaces: Thai and Lao, Myanmar, Khmer, Tai, Balinese and Javanese, kana and Han, Yi, Tangut.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x2E80, 0x2FDF), (0x3005, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF),
    (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF),
)
JOINERS = (0xAD, 0x200C, 0x200D)
_GAP, _PART, _SINGLE = 0, 1, 2


@lru_cache(1)
def _classes() -> np.ndarray:
    """Per code point below 0x20000: separator, part of a word, or a word by itself."""
    out = np.full(0x20000, _PART, np.uint8)
    for code in range(0x80, len(out)):
        kind = unicodedata.category(chr(code))
        if kind[0] in "PZ" or kind in ("Cc", "Cf") and code not in JOINERS:
            out[code] = _GAP
        elif kind in ("Sc", "Sm", "So"):
            out[code] = _SINGLE
    for low, high in UNSPACED:
        part = out[low : high + 1]
        part[part == _PART] = _SINGLE
    return out


def find_terms(data: np.ndarray, bounds: np.ndarray):
    """As ``find_words``, by Unicode's classes: runs of letters, marks and digits, or one character of ``UNSPACED`` or a symbol."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return find_words(data, bounds, ALNUM)
    first = data[lead]
    size = 2 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
    code = (first & (0x7F >> size).astype(np.uint8)).astype(np.int64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << 6 | (data[lead[more] + k] & 0x3F)
    table = _classes()
    # beyond the table lie Han characters, then marks and private ones
    kind = np.where(code < len(table), table[np.minimum(code, len(table) - 1)], np.where(code < 0x40000, _SINGLE, _PART))
    mask = ALNUM[data]
    gap = kind == _GAP
    for k in range(4):
        mask[lead[gap & (size > k)] + k] = False
    cut = np.zeros(len(data) + 1, bool)  # a word ends before these bytes
    single = kind == _SINGLE
    cut[lead[single]] = True
    cut[lead[single] + size[single]] = True
    cut[bounds] = True
    starts = np.flatnonzero(mask & (cut[:-1] | ~np.append(False, mask[:-1])))
    ends = np.flatnonzero(mask & (cut[1:] | ~np.append(mask[1:], False))) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """One 64-bit hash per word; ``fold`` ignores the case of A to Z."""
    powers, inverse = _power_tables(len(data))
    terms = (_FOLDED if fold else _BYTE)[data]
    terms *= powers[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of the given lengths over consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def per_slice(
    make: Callable[[], Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch | None]], text: str,
    release: Callable[[], None] | None = None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: calls ``make()`` once per task, its result once per slice of each batch, and
    ``release()`` when the task ends: workers live on, and what they keep counts against the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                texts = strings(batch.column(text))
                for lo, hi in slices(texts):
                    made = work(batch.slice(lo, hi - lo), texts.slice(lo, hi - lo))
                    if made is not None:
                        yield made
        finally:
            if release is not None:
                release()

    return run


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or the first variant that no column has, whatever the case."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
