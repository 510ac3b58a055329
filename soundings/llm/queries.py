"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, toxicity
from .bpe import bpe_digests
from .decontam import decontaminate
from .importance import resample
from .lexical import ranked_search
from .linededup import line_dedup
from .neardup import jaccard_components
from .packing import read_packed, sequence_digests, write_packed
from .quality import quality_rules
from .sampling import fold
from .shared import new_path, table
from .suffixtree import score_texts
from .tokens import id_digests, read_token_ids, write_token_ids
from .urls import UrlRule, canonical, host_of, path_of, url_filter

# The rules every page is judged by. No table lists URLs, so a sixteenth of the canonical URLs makes up the list: those whose MD5 begins with this digit.
URL_RULES = (UrlRule("block", "net"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))
LISTED_DIGIT = "7"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    return out.select("row.doc_id", (fold("row.doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_deleted", "emptied", F.length("row.text").cast("long").alias("n_chars_kept"), F.md5("row.text").alias("text_md5"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return id_digests(read_token_ids(spark, path))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    listed = pages.where(F.md5(canonical(host_of(url), path_of(url))).startswith(LISTED_DIGIT)).select("url")
    return url_filter(pages, listed, URL_RULES).select("row.page_id", "host", "path", "rule", "verdict")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 7) != 2).alias("learn"))
    out = score_texts(docs)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("row.doc_id", (fold("row.doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "packed")
    write_packed(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, most=2048)
    return sequence_digests(read_packed(spark, path))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20, longest=1, buckets=10_000, seed=2024)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), depth=10)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_line_dedup, op3_token_ids, op4_quality_rules, op5_url_filters, op6_lm_scoring, op7_ngram_jaccard, op8_language_id, op9_decontamination, op10_bpe, op11_packing, op12_importance, op13_lexical_search)}
