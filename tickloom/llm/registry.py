"""Queries of the operators over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, collocations, langid, minhash, mixing, packing, pii, quality, sentencepieces, substrings, suffixes, topk, treaps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


@_query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


@_query("op6_pii_spans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


CONTROL = "<|im_end|><|im_start|>assistant ok"

OP2_SQL = f"""
WITH every AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
ordered AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM every),
shown AS (
  SELECT *, replace(replace(replace(r, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') AS er,
         replace(replace(t, '&', '&amp;'), '<|', '&lt;|') AS et
  FROM ordered)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY n) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(er) + length(et)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""


@_query("op2_chat_format", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return chat.digest(chat.format_chats(chat.threads(rows.unionByName(more)), numbered=True))


OP8_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(strlen(coalesce(text, ''))) AS tokens FROM documents GROUP BY source),
used AS (SELECT tokens / sum(tokens) OVER () AS p FROM sizes WHERE tokens > 0),
ends AS (SELECT max(p) AS high, min(p) AS low, count(*) AS n FROM used),
bisect(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN good THEN lo ELSE mid END, CASE WHEN good THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, pow((SELECT high / low FROM ends), 1 - (lo + hi) / 2) <= 2.0 AS good FROM bisect WHERE i < 40)),
chosen AS (SELECT CASE WHEN (SELECT n FROM ends) > 1 THEN round(hi, 6) ELSE 1.0 END AS t FROM bisect WHERE i = 40),
z AS (SELECT sum(pow(p, t)) AS z FROM used, chosen),
plan AS (
  SELECT source, CAST(tokens AS BIGINT) AS tokens, t, CASE WHEN tokens > 0 THEN round(pow(tokens / total, t) / z, 9) ELSE 0.0 END AS weight,
         CASE WHEN tokens > 0 THEN round(pow(high / (tokens / total), 1 - t), 9) ELSE 1.0 END AS times
  FROM sizes, chosen, z, ends, (SELECT sum(tokens) AS total FROM sizes)),
whole AS (SELECT *, CAST(floor(times) AS BIGINT) AS k, floor((times - floor(times)) * tokens + 1e-6) AS budget, greatest(1, CAST(ceil(tokens / 2000000.0) AS BIGINT)) AS blocks FROM plan),
last AS (
  SELECT d.doc_id, d.source, strlen(coalesce(d.text, '')) AS n, k, budget, times - k AS part,
         md5('17:' || k || ':' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')) AS h, blocks, weight
  FROM documents d JOIN whole w ON d.source IS NOT DISTINCT FROM w.source),
run AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY CAST('0x' || substr(h, 1, 8) AS BIGINT) % blocks, h) AS total FROM last),
used_times AS (SELECT *, k + CASE WHEN part > 0 AND total <= budget THEN 1 ELSE 0 END AS copies FROM run),
copies AS (
  SELECT doc_id, source, n, weight, blocks, unnest(range(copies)) AS epoch FROM used_times),
placed AS (SELECT *, md5('17:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM copies)
SELECT doc_id, source, CAST(epoch AS BIGINT) AS epoch, CAST('0x' || substr(h, 1, 8) AS BIGINT) % blocks AS block, h AS place, CAST(n AS BIGINT) AS n_tokens, weight FROM placed
"""


@_query("op8_source_mix", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"), F.col("mix_order").alias("place"), mixing.tokens().alias("n_tokens"), F.col("mix_weight").alias("weight"))


@_query("op3_best_fit_pack")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), source_conflicts=(("src1", "src2"),))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.r AS r, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""


@_query("op9_exact_topk", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"))


@_query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query("op4_minhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, num=85)


@_query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


@_query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), with_bytes=False).drop("kept_bytes")


@_query("op11_sentencepiece")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digest(sentencepieces.encode(_table(spark, sf_dir, "documents")))


OP12_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
sizes AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held SEMI JOIN asked USING (term) GROUP BY term), whole),
scored AS (
  SELECT item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN sizes USING (r), whole GROUP BY item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored JOIN sizes USING (r) WHERE score > 0 QUALIFY rank <= 20
"""


@_query("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treaps.search(treaps.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
own AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w, count(*) AS c FROM pieces GROUP BY ALL HAVING len(w) > 0),
total AS (SELECT lang, CAST(sum(c * len(w)) AS BIGINT) AS n FROM own GROUP BY lang),
grams AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, c FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM own, (SELECT unnest([1, 2, 3, 4, 5]) AS m))),
counted AS (SELECT lang, m, phrase, CAST(sum(c) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING sum(c) >= 100),
candidate AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE m > 1),
cut AS (SELECT *, array_to_string(w[1:k], ' ') AS a_part, array_to_string(w[k + 1:], ' ') AS b_part FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.f AS a, x.f AS l, y.f AS r, n, CAST(CAST(1000 AS HUGEINT) * cut.f * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, k
  FROM cut JOIN counted x ON x.lang = cut.lang AND x.phrase = a_part JOIN counted y ON y.lang = cut.lang AND y.phrase = b_part JOIN total ON total.lang = cut.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT DISTINCT lang, f, array_to_string(w[i : i + s - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM candidate, (SELECT unnest([2, 3, 4]) AS s) WHERE s < m)),
kept AS (SELECT * FROM weakest v WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = v.lang AND i.phrase = v.phrase AND 100 * i.f >= 100 * v.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000
"""


@_query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


_query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
