"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as registry
from conftest import TESTDATA
from tidewell.catalog import inputs
from tidewell.operators import postings as P
from tidewell.operators.latest import upsert_latest

SMALL = f"{TESTDATA}/sf0.001"
PYTHON_FREE = [
    "tokenize_documents", "inverted_index", "search_top20_candidate", "search_top20_corpus", "tfidf_weights_documents",
    "weighted_rating", "ngram_counts", "content_recommend", "ratings_pivot_mean", "similar_items",
    "user_zero_filled_mean", "upsert_latest", "prize_after_tax", "weather_flatten", "tweet_extract",
]


CORE = sorted(set(registry.queries()) - set(registry.TRAINING))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def steps(monkeypatch):
    """The plans of all tables written on the way."""
    plans, write = [], DataFrameWriter.parquet

    def recorded(self, *args, **settings):
        plans.append(plan(self._df))
        return write(self, *args, **settings)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    return plans


@pytest.mark.parametrize("name", CORE)
def test_no_query_crosses_tables(spark, steps, name):
    steps.append(plan(registry.queries()[name](spark, SMALL)))
    for text in steps:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_core_path_stays_on_the_jvm(spark, steps, name):
    steps.append(plan(registry.queries()[name](spark, SMALL)))
    for text in steps:
        assert not re.search(r"Python|Pandas|Arrow(?!Eval)", text)


@pytest.mark.parametrize("name", ["search_top20_candidate", "search_top20_corpus", "tfidf_weights"])
def test_documents_are_tokenised_once_over_all_steps(spark, steps, name):
    steps.append(plan(registry.queries()[name](spark, SMALL)))
    assert sum(len(re.findall(r"regexp_extract_all\(lower\(p_name", text)) for text in steps) == 1


def test_scan_reads_needed_columns_only(spark):
    text = plan(inputs.ratings(spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_filters_reach_the_scan(spark):
    text = plan(inputs.table(spark, SMALL, "orders").where("o_custkey = 7").select("o_orderkey"))
    assert "EqualTo(o_custkey,7)" in text


def test_rankings_are_cut_before_the_shuffle(spark):
    rows = inputs.table(spark, SMALL, "events").select("user_id", "ts", "value")
    text = plan(upsert_latest(rows, rows, ["user_id"], "ts"))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_tokenizer_runs_once_per_document(spark):
    docs = P.with_tokens(inputs.products(spark, SMALL), "name")
    assert plan(P.term_counts(docs)).count("regexp_extract_all") == 1
