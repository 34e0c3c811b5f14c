"""Spelling variants: words one edit apart, found by search schemes on forward and reversed FM-indexes.

* Vocabulary. Words and their numbers are counted by Spark; only words are indexed, not texts.
* Scheme. One edit leaves the left or the right half of a word whole. The left half is matched exactly, then the match is
  extended over the right half with one edit; and the other way round. Extending to the left is backward search in the
  FM-index of the words, extending to the right is backward search in that of the reversed words. With one edit no search
  turns round, so each keeps the suffix-rank interval of its own direction only. An edit is made where it can't be
  made one place further on, and a match that keeps the left half counts for the first search only, so
  that a pair is found once.
* Blocks. Both words share the first (or last) three code points, so words are dealt by these to blocks of about
  ``BLOCK_WORDS``, once for each direction, and a block is indexed and searched by one task. A key with more words than that is
  cut into several blocks; its words are searched in each of them. Such keys are fewer than the words divided by ``BLOCK_WORDS``.
* Where an interval is wider than the alphabet, each symbol is tried instead of each row of it. A block hands on one row per
  word (number of near words and the best of them), not the pairs.

Defined results: null texts have no words; a null key counts as the empty string; words of fewer than ``LEAST`` code points
are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.session import discard, materialize

LEAST = 7
KEY = 3
TIMES = 10
BLOCK_WORDS = 1 << 15
QUERIES, CELLS = 1 << 12, 1 << 20
RUNS = "([A-Za-zÀ-ÿ]{%d,})"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "word string, n long, own boolean, n_near long, form_n long, form string"


class Index:
    """FM-index of distinct words over symbols 1, 2, ...; 0 ends a word, and ends are ordered by word number."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, n_symbols: int):
        k, n = len(lengths), len(symbols) + len(lengths)
        self.words, self.n_symbols, self.step = k, n_symbols, n + 1
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        rank = np.where(inside, text + k - 1, 0)
        rank[ends] = np.arange(k)
        _, rank = np.unique(rank, return_inverse=True)
        reach = 1
        while n and rank.max() < n - 1:  # doubling; distinct ends bound it by the longest word
            after = np.append(rank[reach:] + 1, np.zeros(min(reach, n), np.int64))
            _, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
            reach *= 2
        suffixes = np.argsort(rank)
        before = np.where(suffixes > 0, text[suffixes - 1], 0) if n else text
        self.before = before
        self.order = np.argsort(before, kind="stable")
        self.keys = before[self.order] * self.step + self.order
        self.word = np.searchsorted(ends, suffixes)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + match."""
        base = symbol * self.step
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def whole(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The word that is the whole match, or -1."""
        at, end = np.searchsorted(self.keys, low), np.searchsorted(self.keys, high)
        out = np.full(len(low), -1, np.int64)
        there = at < end
        out[there] = self.word[self.order[at[there]]]
        return out

    def symbols(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval number, symbol): every symbol but the end that stands before a match, perhaps some that don't."""
        wide = high - low > self.n_symbols
        few, many = np.flatnonzero(~wide), np.flatnonzero(wide)
        size = (high - low)[few]
        owner = np.repeat(few, size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        pairs = np.unique(owner * (self.n_symbols + 1) + self.before[place])
        owner, symbol = pairs // (self.n_symbols + 1), pairs % (self.n_symbols + 1)
        owner, symbol = owner[symbol > 0], symbol[symbol > 0]
        every = np.tile(np.arange(1, self.n_symbols + 1), len(many))
        return np.append(owner, np.repeat(many, self.n_symbols)), np.append(symbol, every)


def one_edit(index: Index, queries: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word): indexed words one edit from a query whose last ``exact`` symbols are the query's.

    ``queries`` has a row per query: its symbols from the last to the first, then zeros.
    """
    m = len(lengths)
    low, high = np.zeros(m, np.int64), np.full(m, index.words, np.int64)
    states = []
    padded = np.column_stack([queries, np.zeros((m, 2), np.int64)])
    for j in range(int(lengths.max(initial=0)) + 1):
        here = np.flatnonzero((j >= exact) & (j <= lengths) & (low < high))
        owner, symbol = index.symbols(low[here], high[here])
        owner = here[owner]
        other = symbol != padded[owner, j]  # never true of the next symbol; at the end of the query that is 0
        owner, symbol = owner[other], symbol[other]
        below, above = index.extend(symbol, low[owner], high[owner])
        open_ = below < above
        owner, below, above = owner[open_], below[open_], above[open_]
        states.append((owner, below, above, np.full(len(owner), j)))  # a symbol more
        inner = j < lengths[owner]
        states.append((owner[inner], below[inner], above[inner], np.full(int(inner.sum()), j + 1)))  # another symbol
        skipped = here[(j < lengths[here]) & (padded[here, j] != padded[here, j + 1])]
        states.append((skipped, low[skipped], high[skipped], np.full(len(skipped), j + 1)))  # a symbol less
        go = np.flatnonzero(j < lengths)
        low[go], high[go] = index.extend(padded[go, j], low[go], high[go])
    query, low, high, place = (np.concatenate(part) for part in zip(*states))
    found = []
    while len(query):
        done = place == lengths[query]
        word = index.whole(low[done], high[done])
        found.append((query[done][word >= 0], word[word >= 0]))
        query, low, high, place = (x[~done] for x in (query, low, high, place))
        low, high = index.extend(padded[query, place], low, high)
        open_ = low < high
        query, low, high, place = query[open_], low[open_], high[open_], place[open_] + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found))


def search_block(words: list[str], indexed: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, match) numbers of the pairs that one direction finds among ``words``; matches are ``indexed`` ones."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    alphabet, codes = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), return_inverse=True)
    codes = codes + 1
    starts = np.cumsum(lengths) - lengths
    half = lengths // 2
    exact = half if rightward else lengths - half
    rows = np.flatnonzero(indexed)
    inside = np.arange(int(lengths[rows].sum())) - np.repeat(np.cumsum(lengths[rows]) - lengths[rows], lengths[rows])
    # extending to the right is backward search over the reversed words
    at = np.repeat(lengths[rows] - 1, lengths[rows]) - inside if rightward else inside
    index = Index(codes[np.repeat(starts[rows], lengths[rows]) + at], lengths[rows], len(alphabet))
    found = []
    by_length = np.argsort(lengths, kind="stable")
    done = 0
    while done < len(words):
        some = by_length[done : done + QUERIES]
        fits = np.arange(1, len(some) + 1) * lengths[some] <= CELLS
        some = some[: max(1, int(fits.sum()))]
        done += len(some)
        column = np.arange(int(lengths[some].max()))
        place = column if rightward else lengths[some, None] - 1 - column
        there = column < lengths[some, None]
        queries = np.where(there, codes[np.where(there, starts[some, None] + place, 0)], 0)
        query, match = one_edit(index, queries, lengths[some], exact[some])
        query, match = some[query], rows[match]
        if not rightward:  # with a whole left half, the other direction finds the pair
            fresh = [words[j][: half[i]] != words[i][: half[i]] for i, j in zip(query.tolist(), match.tolist())]
            query, match = query[np.array(fresh, bool)], match[np.array(fresh, bool)]
        found.append((query, match))
    return tuple(np.concatenate(part) for part in zip(*found))


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, slips: int = 31) -> DataFrame:
    """(word, n): runs of letters with A to Z lower-cased, found at least twice.

    Where ``slips`` divides the crc32 of ``key:run``, the code point at that crc modulo the length is left out.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUNS % least), F.lit(1))).alias("run"),
    )
    runs = runs.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    words = runs.select(F.when(F.col("h") % slips == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def _dealt(words: DataFrame, end: Column, block_words: int, n_blocks: int) -> DataFrame:
    """(block, word, n, own): each word in its block, and in the other blocks of its key as a query only."""
    keyed = words.withColumn("key", end)
    large = keyed.groupBy("key").count().where(F.col("count") > block_words)
    parts = large.select("key", F.ceil(F.col("count") / block_words).cast("int").alias("parts"))
    # fewer rows than words / block_words
    known = keyed.join(F.broadcast(parts), "key", "left").withColumn("of", F.coalesce("parts", F.lit(1)))
    each = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    home = F.pmod(F.xxhash64("word"), F.col("of")).cast("int")
    name = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("string")).otherwise(
        F.concat_ws("/", F.lit("key"), "key", "part")
    )
    return each.select(name.alias("block"), "word", "n", (F.col("part") == home).alias("own"))


def neighbours(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n) with distinct words -> (word, n, n_near, form_n, form): how many words are one edit away, and the
    commonest of them (ties: the first in code-point order)."""

    def searched(rightward: bool):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("word", ignore_index=True)
            words, n, own = list(rows["word"]), rows["n"].to_numpy(), rows["own"].to_numpy(bool)
            query, match = search_block(words, own, rightward)
            order = np.lexsort((match, -n[match], query))  # words are sorted, so a smaller number is a smaller word
            query, match = query[order], match[order]
            heads = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else query
            near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
            near[query[heads]] = np.diff(np.append(heads, len(query)))
            best[query[heads]] = match[heads]
            some = np.flatnonzero(own | (near > 0))
            found = best[some]
            return pd.DataFrame({
                "word": rows["word"].to_numpy()[some], "n": n[some], "own": own[some], "n_near": near[some],
                "form_n": np.where(found >= 0, n[found], 0), "form": [words[i] if i >= 0 else None for i in found],
            })

        return run

    n_blocks = words.count() // block_words + 1
    sides = []
    for rightward, end in ((True, F.substring("word", 1, KEY)), (False, F.substring("word", -KEY, KEY))):
        blocks = _dealt(words.where(F.length("word") >= 2 * KEY), end, block_words, n_blocks)
        sides.append(blocks.groupBy("block").applyInPandas(searched(rightward), FOUND))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    both = sides[0].unionByName(sides[1]).groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best)
    return both.select("word", "n", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def variants(words: DataFrame, times: int = TIMES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n) -> (word, form, root, n, n_near, form_n): a word's form is its commonest near word, if that is at
    least ``times`` as common; its root is the last of the forms that follow."""
    found = neighbours(words, block_words)
    accepted = F.coalesce(F.col("form_n").cast("decimal(20,0)") >= F.col("n").cast("decimal(20,0)") * times, F.lit(False))
    found = materialize(found.select(
        "word", F.when(accepted, F.col("form")).alias("form"), "n", "n_near", F.when(accepted, F.col("form_n")).alias("form_n")
    ), "variant-forms")
    links = materialize(found.where("form is not null").select("word", F.col("form").alias("root")), "variant-links")
    moved = True
    while moved:  # each round doubles the steps; numbers grow along a chain, so there are few
        further = links.select(F.col("word").alias("root"), F.col("root").alias("far"))
        fresh = materialize(links.join(further, "root", "left").select("word", "root", "far"), "variant-round")
        moved = not fresh.where("far is not null").isEmpty()
        discard(links)
        links = fresh.select("word", F.coalesce("far", "root").alias("root"))
        if moved:
            links = materialize(links, "variant-links")
            discard(fresh)
    return found.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
