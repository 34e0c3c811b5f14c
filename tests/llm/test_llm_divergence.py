"""Divergence rules against SQL and by hand."""

import re

from check import difference
import duckdb
import pytest

from llm_cases import WORDS, documents, empty, prose, rows
from tidewell.llm import divergence


def by_hand(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    "a b c a b c", "a b a b a b a b", "x\nx\n\n\ny\nx ", "# * $ % & | < > é🙂", "a\tb\x0bc\x0cd\re\x1cf g", "w " * 60,
    prose(1, 60) + "\n" + prose(1, 60), prose(2, 49), prose(2, 50), "| ".join(prose(3, 120).split()), "a b c x a b c y a b",
]


def test_counts_by_hand(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)] + [(99, None, None)], "doc_id long, text string, lang string")
    for r in divergence.judge(docs).collect():
        text = None if r["doc_id"] == 99 else TEXTS[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == by_hand(text)
        assert not (r["base_failed"] and r["kept"])


def test_edges_against_sql(spark):
    docs = documents(spark).where("doc_id <> 6 or doc_id is null")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows() if r[0] != 6])
    assert difference(divergence.judge(docs), con, divergence.SQL) is None


def test_common_words_of_any_length(spark):
    usual = ["Donaudampfschiffahrt", "selbstverständlich", "Zusammenarbeit", "beziehungsweise"]
    texts = [(i, " ".join(f"{usual[(i + k) % 4]} w{i * 40 + k}" for k in range(60)), "de") for i in range(50)]
    odd = [(99, " ".join(f"v{k}" for k in range(120)), "de")]
    docs = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string")
    assert set(usual) <= set(divergence.common_words(docs).first()["top_words"])
    found = {r["doc_id"]: r for r in divergence.judge(docs).collect()}
    assert found[99]["word_distance"] > 0.4 > max(r["word_distance"] for i, r in found.items() if i != 99)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", texts + odd)
    assert difference(divergence.judge(docs), con, divergence.SQL) is None


def test_a_very_long_text(spark):
    r = divergence.judge(documents(spark)).where("doc_id = 6").first()
    assert r["n_words"] == 60_000 and r["n_repeat_words"] > 30_000 and r["base_failed"]


def test_strange_texts_are_rejected_and_common_ones_kept(spark):
    plain = [(i, prose(i, 150) + " the of and", "en") for i in range(200)]
    odd = [(1000, " ".join(f"{w}$%#" for w in prose(900, 150).split()), "en")]
    found = divergence.judge(spark.createDataFrame(plain + odd, "doc_id long, text string, lang string")).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == {1000}


def test_empty_table(spark):
    assert divergence.judge(empty(spark)).count() == 0


@pytest.mark.parametrize("table", [documents, empty])
def test_native(spark, table):
    plan = divergence.judge(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|ArrowEval|MapIn", plan)
