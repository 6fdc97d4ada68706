"""From raw documents to a training mix: quality, near copies, repeated strings, benchmark leaks, weights of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents, staged
from railtempo.llm.decontaminate import clean_documents
from railtempo.llm.mixing import mix
from railtempo.llm.quality_classifier import classify
from railtempo.llm.simhash_dedup import one_of_each_group
from railtempo.llm.suffix_dedup import remove_repeated_strings


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained with the table's labels, holds for clean.

    Null and empty texts are judged like others, equal rows alike; an empty table stays empty.
    """
    judged = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter("kept").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash; of equal rows one, of texts without words one."""
    return one_of_each_group(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur again; characters that a cut leaves in part go too. A null text is empty."""
    done = remove_repeated_strings(docs)
    left = F.col("kept").cast("string")
    text = F.when(F.size("removed") == 0, left).otherwise(F.replace(F.make_valid_utf8(left), F.lit("\ufffd"), F.lit("")))
    done = done.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; null and empty texts have none, equal rows all stay."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its copies in the mix (0 to 2), and what that is in words, in place of columns of these names.

    Rows get a number, written with them once, by which each meets its own plan, whatever rows are equal.
    """
    made = ["size", "source_size", "target", "copies", "taken"]
    others = [c for c in docs.columns if c.lower() not in made]
    numbered = docs.select(*[F.col(f"`{c}`") for c in others], F.monotonically_increasing_id().alias("__row"))
    numbered = staged(numbered, "mix-rows")
    plan = mix(numbered, row="__row").select("__row", *made)
    return numbered.join(plan, "__row").select(*[F.col(f"`{c}`") for c in others], *made)


STAGES = [
    ("quality_classifier", keep_clean),
    ("simhash_dedup", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Trained, hashed and random steps: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written as Parquet and read again for the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
