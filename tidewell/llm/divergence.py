"""Quality rules by distribution divergence, in DataFrame functions only.

Each text is compared with the reference of its language, which is counted over all rows of
that language: the shares of seven character classes, and the shares of its most frequent
words, of any length, and of all other words. The measure is the Jensen-Shannon distance (base 2, 0 to 1).
Histograms of few words say little, so texts below a least length fail the base rules,
and the words are compared from ``WORD_GUARD`` words on only.

Words are runs of characters other than space and 0x09-0x0D. The base rules: at least 50 words, and
at most half of the words in three-word windows that occur twice or more in the text.

Defined results: a null text counts as empty and fails the base rules; rows without a language share
the reference of the empty language; repeated rows are judged alike; the distances of
a text below the guards are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.session import materialize

LEAST_WORDS = 50
WORD_GUARD = 100
TOP_WORDS = 16
CHAR_LIMIT = 0.31
WORD_LIMIT = 0.4
SPACE = r"[\x20\x09-\x0D]"
# Classes counted by a pattern; the last class is what is left, mostly small letters.
CLASSES = {
    "space": SPACE, "upper": "[A-Z]", "digit": "[0-9]", "symbol": "[#*$%&|<>]",
    "punctuation": r"[!\x22\x27()+,./:;=?@\x5B-\x60{}~-]", "wide": r"[^\x00-\x7F]",
}


def _half(p: Column, q: Column) -> Column:
    """p log2(p / m) with m the mean of p and q; 0 at p = 0."""
    return F.when(p > 0, p * F.log(p / ((p + q) / 2)) / F.lit(math.log(2))).otherwise(F.lit(0.0))


def _total(shares: str | Column) -> Column:
    return F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)


def whole(shares: Column) -> Column:
    """The shares and the rest up to 1 as a last one."""
    return F.concat(shares, F.array(F.greatest(F.lit(1.0) - _total(shares), F.lit(0.0))))


def distance(shares: str, others: str) -> Column:
    """Jensen-Shannon distance of two columns of shares in the same order, rounded to 6 digits."""
    parts = F.zip_with(shares, others, lambda p, q: _half(p, q) + _half(q, p))
    return F.when(F.col(shares).isNotNull(), F.round(F.sqrt(F.greatest(_total(parts) / 2, F.lit(0.0))), 6))


def _outside(pattern: str) -> str:
    """Runs of the characters that a class does not hold."""
    inner = pattern[1:-1]
    return f"[{inner[1:]}]+" if inner.startswith("^") else f"[^{inner}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _counted(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Key, language, text, words, code points and the characters of each class."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(lang, F.lit("")).alias("lang"),
                       F.coalesce(text, F.lit("")).alias("text"))
    counts = [
        F.char_length(F.regexp_replace("text", F.lit(_outside(pattern)), F.lit(""))).cast("long").alias(name)
        for name, pattern in CLASSES.items()
    ]
    return rows.select("id", "lang", "text", _words(F.col("text")).alias("words"),
                       F.char_length("text").cast("long").alias("chars"), *counts)


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: its most frequent words with their counts, most frequent first."""
    words = _words(F.coalesce(text, F.lit("")))
    each = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.explode(words).alias("word"))
    counts = each.groupBy("lang", "word").agg(F.count("*").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_WORDS)
    tops = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    return tops.select(F.col("lang").alias("top_lang"), F.transform("top", lambda x: x["word"]).alias("top_words"),
                       F.transform("top", lambda x: x["n"]).alias("top_counts"))


def reference(counted: DataFrame, tops: DataFrame) -> DataFrame:
    """One row per language, from the counts of all its rows and its common words: shares of classes and of words."""
    totals = counted.groupBy("lang").agg(
        F.sum("chars").alias("chars"), *(F.sum(c).alias(c) for c in CLASSES), F.sum("n_words").alias("n")
    )
    return totals.join(tops, F.col("lang") == F.col("top_lang"), "left").select(
        F.col("lang").alias("ref_lang"),
        F.array(*(F.try_divide(c, "chars") for c in CLASSES)).alias("ref_classes"),
        F.transform("top_counts", lambda x: F.try_divide(x, F.col("n"))).alias("ref_shares"),
    )


def repeated_words(words: str) -> tuple[list, Column]:
    """Columns to add one after the other, and the number of words in three-word windows found twice or more."""
    n = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    triple = lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2))
    triples = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), triple))
    # only texts in which some window repeats have their windows sorted
    windows = F.when(
        F.size(F.array_distinct("triples")) < F.size("triples"),
        F.sort_array(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    )
    twice = F.filter(
        "windows",
        lambda x, i: ((i > 0) & (F.get("windows", i - 1)["h"] == x["h"])) | (F.coalesce(F.get("windows", i + 1)["h"] == x["h"], F.lit(False))),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["at"]))
    # a window adds the words that the one before it does not reach
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    step = lambda acc, at: F.struct(
        at.alias("last"), (acc["total"] + F.least(F.lit(3), at - acc["last"])).cast("long").alias("total")
    )
    return [("hashes", hashes), ("triples", triples), ("windows", windows), ("places", places)], F.coalesce(
        F.aggregate("places", start, step, lambda acc: acc["total"]), F.lit(0).cast("long")
    )


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Counts, distances and verdict of every row: (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance)."""
    # stored first: by its true size, a row per language, the planner sends it to all tasks
    tops = materialize(common_words(docs, text, lang), "common-words")
    rows = _counted(docs, key, text, lang).join(tops, F.col("lang") == F.col("top_lang"), "left")
    steps, repeated = repeated_words("words")
    for name, column in steps:
        rows = rows.withColumn(name, column)
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines)
    n_words = F.size("words")
    held = F.array(*(n_words - F.size(F.array_remove("words", F.get("top_words", F.lit(i)))) for i in range(TOP_WORDS)))
    counted = rows.select(
        "id", "lang", "chars", *CLASSES, n_words.cast("long").alias("n_words"), repeated.alias("n_repeat_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n_words >= WORD_GUARD, F.slice(held, 1, F.size("top_words"))).alias("held"),
    )
    # counted once for the references and for the verdicts
    counted = materialize(counted, "counts")
    known = counted.join(materialize(reference(counted, tops), "references"), F.col("lang") == F.col("ref_lang"), "left")
    known = known.select(
        "id", "chars", "space", "symbol", "n_words", "n_repeat_words", "n_dup_lines",
        F.array(*(F.try_divide(c, "chars") for c in CLASSES)).alias("classes"), "ref_classes",
        F.transform("held", lambda x: F.try_divide(x, F.col("n_words"))).alias("shares"),
        F.coalesce("ref_shares", F.array().cast("array<double>")).alias("ref_shares"),
    )
    known = known.withColumns({c: whole(F.col(c)) for c in ("classes", "ref_classes", "shares", "ref_shares")})
    zero = F.lit(0.0)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = known.select(
        F.col("id").alias(key), "n_words", (F.col("chars") - F.col("space")).alias("word_chars"),
        F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.when(F.col("n_words") >= LEAST_WORDS, distance("classes", "ref_classes")).alias("char_distance"),
        distance("shares", "ref_shares").alias("word_distance"),
    )
    near = (F.coalesce("char_distance", zero) <= char_limit) & (F.coalesce("word_distance", zero) <= word_limit)
    return measured.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "char_distance", "word_distance",
    )


def _sql_half(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN {p} * ln({p} / (({p} + {q}) / 2)) / {math.log(2)!r} ELSE 0 END)"


def _sql_pattern(pattern: str) -> str:
    return pattern.replace("'", "''")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
c AS (SELECT r, doc_id, lang, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, length(text) AS chars, {", ".join(
    f"len(regexp_extract_all(text, '{_sql_pattern(p)}')) AS \"{n}\"" for n, p in CLASSES.items())} FROM d),
chars AS (SELECT lang, sum(chars) AS chars, sum(len(words)) AS n, {", ".join(f'sum("{n}") AS "{n}"' for n in CLASSES)}
          FROM c GROUP BY lang),
each AS (SELECT r, lang, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM c),
top AS (SELECT lang, word, count(*) AS n FROM each GROUP BY lang, word
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {TOP_WORDS}),
ref AS (SELECT lang, word, top.n / chars.n AS q FROM top JOIN chars USING (lang)),
tri AS (SELECT r, pos, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t FROM each WINDOW o AS (PARTITION BY r ORDER BY pos)),
dup AS (SELECT r, pos FROM tri WHERE t IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
rep AS (SELECT r, count(DISTINCT pos + k) AS n_repeat_words FROM dup, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
line AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
         FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM c)
         WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
used AS (SELECT r, word, count(*) AS n FROM each GROUP BY ALL),
held AS (SELECT c.r, ref.q, coalesce(used.n, 0) / len(words) AS p
         FROM c JOIN ref USING (lang) LEFT JOIN used ON used.r = c.r AND used.word = ref.word WHERE len(words) >= {WORD_GUARD}),
wd0 AS (SELECT r, p, q FROM held UNION ALL
        SELECT r, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM held GROUP BY r),
wd AS (SELECT r, round(sqrt(greatest(sum({_sql_half("p", "q")} + {_sql_half("q", "p")}) / 2, 0)), 6) AS word_distance
       FROM wd0 GROUP BY r),
cd0 AS (SELECT r, unnest([{", ".join(f'c."{n}" / c.chars' for n in CLASSES)}]) AS p,
               unnest([{", ".join(f'chars."{n}" / chars.chars' for n in CLASSES)}]) AS q
        FROM c JOIN chars USING (lang) WHERE len(words) >= {LEAST_WORDS}),
cd1 AS (SELECT r, p, q FROM cd0 UNION ALL
        SELECT r, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM cd0 GROUP BY r),
cd AS (SELECT r, round(sqrt(greatest(sum({_sql_half("p", "q")} + {_sql_half("q", "p")}) / 2, 0)), 6) AS char_distance
       FROM cd1 GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, (c.chars - "space")::BIGINT AS word_chars, "symbol"::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      char_distance, word_distance
      FROM c LEFT JOIN rep USING (r) LEFT JOIN line USING (r) LEFT JOIN wd USING (r) LEFT JOIN cd USING (r)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND coalesce(char_distance, 0) <= {CHAR_LIMIT} AND coalesce(word_distance, 0) <= {WORD_LIMIT} AS kept
FROM b
"""
