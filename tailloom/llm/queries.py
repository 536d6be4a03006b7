"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extraction, fim, langid, licences, media, neighbours, ngramjoin, packing, pieces, simhash, suffixes, warc, whitening
from .common import table


def op1_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.kept_digests(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored"))
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # null where it takes more than 63 bits


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bestfit_packing, op2_simhash_near_dedup, op3_licence_scan, op4_language_id, op5_suffix_dedup, op6_nearest_neighbours, op7_media_columns, op8_sentencepiece, op9_warc, op10_html_extraction, op11_fill_in_middle, op12_embedding_whitening, op13_ngram_jaccard_join)}

_DRAWS = ", ".join(f"CAST('0x' || substr(h, {i * 8 + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
ORACLE_SQL: dict[str, str] = {
    "op11_fill_in_middle": f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, n, {_DRAWS} FROM texts),
cuts AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, t, n, form, a, b, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts"""
}
