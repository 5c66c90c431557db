"""The registered queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import divergence, embeddings, mixing, packing, pii, planes, quality, search, sharding, simhash, urls, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


#: The setting that names the key of the pseudonyms. Its value comes from a secret store; without it, as in tests and
#: demonstrations on invented people, the key is a public word.
KEY_SETTING, PUBLIC_KEY = "spark.loanlens.pseudonym.key", "demonstration"


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, PUBLIC_KEY)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = _read(spark, folder, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(utf8) + 16).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
    )
    return sharding.interleaved_shards(narrow, 40, id_columns=("doc_id", "text_crc32", "size")).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_kmeans_cells(spark: SparkSession, folder: str) -> DataFrame:
    found = embeddings.near_duplicates(_read(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op3_segmented_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(_read(spark, folder, "pages"))


def op4_indexed_warc(spark: SparkSession, folder: str) -> DataFrame:
    target = warc.new_folder(spark)
    index = warc.write_archives(_read(spark, folder, "pages"), target)
    return warc.read_records(index, target)


def op5_block_max_wand(spark: SparkSession, folder: str) -> DataFrame:
    asked = _read(spark, folder, "benchmark").where("item_id % 50 = 0")
    return search.search(search.build_index(_read(spark, folder, "documents")), asked, "item_id")


def op6_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    changed = pii.pseudonymized(docs.withColumn("before", F.col("text")), pseudonym_key(spark))
    return changed.select("doc_id", "text", (~F.col("text").eqNullSafe(F.col("before"))).alias("changed"))


def op7_random_indexing_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _read(spark, folder, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_complement_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_read(spark, folder, "documents"), tokenizer_path())


def op9_simhash_balls(spark: SparkSession, folder: str) -> DataFrame:
    classes = simhash.with_classes(_read(spark, folder, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = _read(spark, folder, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("n"))
    mix = mixing.sample_copies(sized, F.col("n"))
    return mix.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    target = planes.new_folder(spark)
    index = planes.write_shards(_read(spark, folder, "documents"), target, tokenizer_path("byte_bpe_50k.json"))
    return planes.read_documents(index, target)


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_read(spark, folder, "documents"))


def op13_qdwh_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_read(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {
    "op1_interleaved_shards": op1_interleaved_shards,
    "op2_kmeans_cells": op2_kmeans_cells,
    "op3_segmented_hosts": op3_segmented_hosts,
    "op4_indexed_warc": op4_indexed_warc,
    "op5_block_max_wand": op5_block_max_wand,
    "op6_feistel_pseudonyms": op6_feistel_pseudonyms,
    "op7_random_indexing_quality": op7_random_indexing_quality,
    "op8_complement_packing": op8_complement_packing,
    "op9_simhash_balls": op9_simhash_balls,
    "op10_pareto_mix": op10_pareto_mix,
    "op11_bit_planes": op11_bit_planes,
    "op12_source_divergence": op12_source_divergence,
    "op13_qdwh_whitening": op13_qdwh_whitening,
}

# Runs of letters A-Z (lowered), digits and characters beyond ASCII are terms.
_BM25 = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark WHERE item_id % 50 = 0) GROUP BY ALL),
size AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM tokens) / (SELECT count(*) FROM documents) AS mean),
lengths AS (SELECT doc_id, count(*) AS len FROM tokens GROUP BY doc_id),
freqs AS (SELECT doc_id, term, count(*) AS tf FROM tokens SEMI JOIN asked USING (term) GROUP BY ALL),
idfs AS (SELECT term, ln(1 + ((SELECT n FROM size) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM freqs GROUP BY term),
scores AS (
  SELECT item_id, doc_id, round(sum(times * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / (SELECT mean FROM size)))), 6) AS score
  FROM asked JOIN freqs USING (term) JOIN idfs USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10
"""

def _round(number: int) -> str:
    """One prefix of the Pareto order: what fits the open words and is not taken yet. Equal rows come in any order."""
    before = f"m{number - 1}"
    return f"""
f{number} AS (SELECT rid, source, open,
    sum(size) OVER (PARTITION BY source ORDER BY pareto, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM {before} WHERE NOT taken AND pareto IS NOT NULL AND size <= open),
t{number} AS (SELECT rid, true AS fits FROM f{number} WHERE run <= open),
c{number} AS (SELECT source, max(run) AS spent FROM f{number} WHERE run <= open GROUP BY source),
m{number} AS (SELECT m.rid, doc_id, m.source, size, source_size, target, whole, pareto, open - coalesce(spent, 0) AS open,
    taken OR coalesce(fits, false) AS taken
  FROM {before} m LEFT JOIN t{number} t ON m.rid = t.rid LEFT JOIN c{number} c ON m.source IS NOT DISTINCT FROM c.source)"""


_MIX = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0 AS u
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w,
  2e0 * source_size AS full_size FROM sources),
levels AS (SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(full_size) OVER (
    ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
  / sum(w) OVER (ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goals AS (SELECT source, source_size, least(full_size, coalesce((SELECT level FROM levels WHERE level <= full_size / w
  ORDER BY full_size / w, source NULLS LAST LIMIT 1) * w, full_size)) AS target FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate FROM goals),
m0 AS (SELECT rid, doc_id, s.source, size, source_size, target, floor(rate) AS whole,
    CASE WHEN rate > floor(rate) THEN u / (1 - u) / ((rate - floor(rate)) / (1 - (rate - floor(rate))) * sqrt(CAST(greatest(size, 1) AS DOUBLE))) END
      AS pareto, target - floor(rate) * source_size AS open, false AS taken
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
{_round(1)}, {_round(2)}, {_round(3)}
SELECT doc_id, source, size, source_size, target, CAST((whole + CAST(taken AS INT)) * size AS BIGINT) AS taken FROM m3
"""

# Every kept term meets every group of its language, also those without it.
_DIVERGENCE = r"""
WITH tokens AS (
  SELECT rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
languages AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, term, count(*) AS c FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n, l.v,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN languages l ON g.lang = l.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
rates AS (SELECT *, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v) AS p FROM every),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM rates WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 50
"""

ORACLES: dict[str, str] = {"op5_block_max_wand": _BM25, "op10_pareto_mix": _MIX, "op12_source_divergence": _DIVERGENCE}
