"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import bpe, chat, collocations, decontam, divergence, language, neardup, pseudonyms, quotient, secret_spans, sharding, tokenfiles, variants
from tidewell.session import materialize, scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SHARDS = [f"shard-{i:03d}" for i in range(64)]
PSEUDONYM_KEY = b"a key for the registered query; a deployment passes its own"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    network = language.fit(docs, learn=language.learn_fold())
    held_out = F.coalesce(~language.learn_fold(), F.lit(False)).alias("held_out")
    return language.predict(docs, network, ["doc_id"]).select("doc_id", held_out, "lang_pred", "score")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_words")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents"), SHARDS)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.mask(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return chat.digests(chat.expand(turns.union(own)))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_spans.find_secrets(docs, secret_spans.fit(docs))

    def spelled(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(spelled("base"), 256).alias("base_sha256"),
        spelled("spans").alias("spans"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), WORD_BPE, out)
    return tokenfiles.document_checks(tokenfiles.read_runs(spark, out)).withColumnRenamed("id", "doc_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient.exact_groups(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = materialize(variants.vocabulary(_table(spark, sf_dir, "documents")), "vocabulary")
    return variants.variants(words)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


# Every special character gets a backslash before it: see chat.escape.
_ESCAPED = r"regexp_replace(%s, '([<>\[\]\\])', '\\\1', 'g')"
OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (SELECT *, row_number() OVER o AS nth, count(*) OVER (PARTITION BY conv_id) AS turns,
      sum(length({_ESCAPED % 'role'}) + length({_ESCAPED % 'text'}) + length('<turn ></turn>')) OVER o AS upto
      FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR nth = turns THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

OP11_SQL = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
  sha256(t) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY t)
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counts AS (SELECT lang, p, count(*) AS f FROM (
    SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda m: list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])))) AS p
    FROM lists) GROUP BY ALL),
candidates AS MATERIALIZED (SELECT lang, p, f AS a FROM counts WHERE len(p) > 1 AND f >= 30),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates),
scored AS (SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.p[:k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[k + 1:]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, len(p)), lambda m:
    list_transform(range(1, len(p) - m + 2), lambda i: p[i:i + m - 1])))) AS p FROM candidates WHERE len(p) > 2),
covered AS (SELECT DISTINCT s.lang, s.p FROM candidates s JOIN inner_parts i ON i.lang = s.lang AND i.p = s.p
  WHERE 100::HUGEINT * i.longer >= 80::HUGEINT * s.a),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, score FROM lowest ANTI JOIN covered USING (lang, p))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

QUERIES = {
    "op1_language_id": (op1_language_id, None),
    "op2_near_duplicates": (op2_near_duplicates, None),
    "op3_sharding": (op3_sharding, None),
    "op4_pseudonyms": (op4_pseudonyms, None),
    "op5_chat_format": (op5_chat_format, OP5_SQL),
    "op6_secrets": (op6_secrets, None),
    "op7_bpe": (op7_bpe, None),
    "op8_token_files": (op8_token_files, None),
    "op9_decontamination": (op9_decontamination, None),
    "op10_divergence": (op10_divergence, divergence.SQL),
    "op11_exact_dedup": (op11_exact_dedup, OP11_SQL),
    "op12_spelling_variants": (op12_spelling_variants, None),
    "op13_collocations": (op13_collocations, OP13_SQL),
}
