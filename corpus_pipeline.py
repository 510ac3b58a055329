"""A corpus pipeline: language, repeated lines, near duplicates, benchmark passages, tokens.

Each stage is written as Parquet in the shared folder and read again by the next. Stages keep all columns of their input, whatever their names;
an empty table gives an empty one. Rows that are equal in id and text share their fate in every stage but ``near_duplicates``, which keeps one of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundings.llm import langid
from soundings.llm.bpe import bpe_digests
from soundings.llm.decontam import decontaminate
from soundings.llm.linededup import line_dedup
from soundings.llm.neardup import jaccard_components
from soundings.llm.sampling import fold
from soundings.llm.shared import row_key, staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language; those without text or letters, and those the model is unsure of, go.

    Rows with a null ``lang`` are judged, not learned from; null ids fall in the fold of empty text. Very long texts are judged whole, equal ones
    equally. Without any row to learn from all go."""
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    return langid.predict(docs, model).where("not rejected").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of runs of lines; documents of which nothing is left go.

    The first position stays: by id (null first), then by a hash of the text. Null, empty and blank texts have nothing to delete and stay; in a very long text
    lines are judged one by one. ``n_chars`` is counted anew."""
    return line_dedup(docs).where("not emptied").select("row.*").withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one row stays: of the least id (null ids last), then of the least hash of the text, then of equal rows one.

    Rows without words are in no group and stay. Texts are compared whole, however long. Of rows equal in id and text the one with the least hash of
    its other columns stays."""
    found = staged(jaccard_components(docs), "found")
    keys = found.where("component is not null").groupBy("component", "_k").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    least = keys.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_k", "rows")).alias("least"))
    alone = found.where("component is null").select("_k", F.lit(1).cast("long").alias("rows")).distinct()
    stay = staged(least.select("least._k", "least.rows").unionByName(alone), "stay")
    own = docs.select(F.struct("*").alias("row")).withColumn("_k", row_key("row.doc_id", "row.text"))
    out = own.join(stay.where("rows = 1").select("_k"), "_k", "left_semi").select("row.*")
    repeated = stay.where("rows > 1").select("_k")
    if repeated.isEmpty():
        return out
    tie = F.xxhash64(*[F.col(f"row.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    copies = staged(own.join(repeated, "_k", "left_semi").withColumn("_tie", tie), "copies")
    return out.unionByName(copies.groupBy("_k").agg(F.min_by("row", "_tie").alias("row")).select("row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any passage of the benchmark go; null and empty texts have none and stay, very long ones are searched whole. An empty benchmark drops none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids and of the text they decode to, a row for every document; null and empty texts have no ids."""
    return bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated), ("tokens", tokens)]
#: Not expressible in SQL (trained model, library tokenizer): tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
