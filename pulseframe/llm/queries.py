"""The registered queries of this package, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import chat, exact_dedup, mixing, near_dedup, packing, pii, quality, spelling, substrings, tokens, topk, vantage, whitening
from pulseframe.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return tokens.token_counts(table(spark, sf_dir, "documents"), model, limit=4096)


@query("op3_simhash_components")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, length=2048,
    )


@query("op5_importance_resampling")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quality.SHARPENED)


@query("op7_source_mix", r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place
  FROM rows GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM named
), shared AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS share
  FROM weighed WINDOW earlier AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN share * weight > 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
              ELSE max(share) OVER () * weight END AS target
  FROM shared
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM rows JOIN targets ON rows.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor(rate) + CASE WHEN
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0
         < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies,
       size * copies AS taken
FROM rated
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@query("op9_exact_duplicates", r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), numbered AS (
  SELECT doc_id, text_sha256, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER same = 1 AS kept
  FROM rows WINDOW same AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM numbered
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op6_chat_format")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id LONG, turn LONG, role STRING, text STRING")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    turns = chat.canonical_turns(rows.select("conv_id", "turn", record.alias("record")))
    return chat.conversation_digests(chat.format_turns(turns))


@query("op10_exact_top_k", """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(p.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable p ON q.vec_id % 20 = 0 AND q.vec_id <> p.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.integer_vectors(table(spark, sf_dir, "embeddings"), scale=64, query_every=20), k=20)


@query("op8_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents"))


@query("op1_repeated_substrings")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), window=400)


@query("op13_spelling_variants", r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT own_id, run, count(*) AS k
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS own_id,
          unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
  WHERE length(run) >= 6 GROUP BY own_id, run
), coded AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(own_id || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM runs, crc_table
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n
  FROM (SELECT k, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM coded)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), holes AS (
  SELECT word, n, i, left(word, i) || '_' || substr(word, i + 2) AS masked, left(word, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), replaced AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.masked = b.masked AND a.i = b.i AND a.word <> b.word
), deleted AS (
  SELECT DISTINCT h.word, h.n, w.word AS near, w.n AS near_n FROM holes h JOIN words w ON h.less = w.word
), near AS (
  SELECT word, near, near_n FROM replaced UNION ALL SELECT word, near, near_n FROM deleted UNION ALL SELECT near, word, n FROM deleted
), best AS (
  SELECT word, count(*) AS n_near, list(near ORDER BY near_n DESC, encode(near))[1] AS form, max(near_n) AS form_n FROM near GROUP BY word
), forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), paths AS (
  WITH RECURSIVE p(word, root, steps) AS (
    SELECT word, word, 0 FROM forms UNION ALL SELECT p.word, f.form, steps + 1 FROM p JOIN forms f ON p.root = f.word AND f.form IS NOT NULL)
  SELECT word, arg_max(root, steps) AS root FROM p GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN paths USING (word)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), scale=256, components=4)


@query("op11_vantage_neighbours")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"), k=10, query_every=100, factor=vantage.FACTOR)
