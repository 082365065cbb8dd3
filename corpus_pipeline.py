"""Corpus pipeline: language ID, near-duplicates, repeated passages, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
as Parquet in the shared folder and rereads it as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import decontaminate, language, packing, phrase_dedup, simhash
from clickmart.llm._store import materialize, ship_package

#: The share of the held-out documents, of each language and of all, that may fall below the limit.
MAX_LOSS = 0.005


def score_limits(docs: DataFrame, model: language.Model, max_loss: float = MAX_LOSS) -> dict[str, float]:
    """For each language the least score that is taken: the ``max_loss`` quantile of its held-out documents' scores, or that of all if it is larger.

    Held out are the documents that the rule of ``language.training_rows``
    keeps from the model, all of them.  Where there are few of a language, its
    own quantile is just their smallest score; that of all then is the limit.
    The key None has the limit of languages without held-out documents (0 if there are none at all).
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    held = language.predict(docs.where((fold == 1) & F.col("lang").isNotNull()).select("text", "lang"), model)
    found = held.where("lang_pred <> 'und'").rollup("lang").agg(F.percentile_approx("score", max_loss, 100_000).alias("limit"))
    limits = {r["lang"]: r["limit"] or 0.0 for r in found.collect()}  # one row for each language, and one for all
    of_all = limits.get(None, 0.0)
    return {None: of_all} | {lang: max(limit, of_all) for lang, limit in limits.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language; rejects texts without letters and ones the classifier cannot place.

    A document cannot be placed if its score is below the limit that this run's
    own held-out documents of the predicted language set.
    """
    ship_package(spark)
    columns = docs.columns
    model = language.fit(language.training_rows(docs))
    limits = score_limits(docs, model)
    # The prediction's columns are renamed aside, so that input columns stay as they are.
    judged = language.predict(docs.select(F.struct(*columns).alias("row"), "text"), model)
    limit = F.lit(limits.pop(None))
    for lang, value in sorted(limits.items()):
        limit = F.when(F.col("lang_pred") == lang, value).otherwise(limit)
    return (judged.where((F.col("lang_pred") != "und") & (F.col("score") >= limit))
            .select(*[F.col("row")[c].alias(c) for c in columns]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates."""
    ship_package(spark)
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each text that has repeated passages by its kept words; all documents stay.

    ``n_chars`` follows the text.  A text without repeats keeps its white space.
    """
    ship_package(spark)
    stripped = phrase_dedup.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    out = stripped.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which 5 % or more of the words are benchmark passages."""
    ship_package(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all remaining documents into sequences of 2,048 tokens; one row for each piece."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_decontamination", benchmark_decontamination), ("sequence_packing", sequence_packing)]

#: Linear models, fingerprints' components and tokenizers are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
