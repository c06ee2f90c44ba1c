"""From raw documents to packed training sequences, in stages that each write a table and read the one before.

1. language: documents whose language the network cannot name (no letter, or hardly any confidence) go;
   where no document has a language to learn from, only those without a letter go
2. exact copies: of equal texts the row with the largest identifier stays
3. near copies: of each group the document with the smallest identifier stays
4. benchmark: documents that hold ten consecutive words of a benchmark item go
5. packing: what is left is packed into sequences; one row per piece

All stages but the last return the columns of their input. Rows are told apart by ``doc_id``; rows without one are kept by
the stages that compare documents. Every decision of a stage is made on the documents it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidehouse import session
from tidehouse.llm import arrow, decontaminate, exact_copies, language, near_copies, packing

#: Least mean probability of the named language, as a part of the way from an even spread over all learned languages to
#: certainty: 0.3 with four languages, 0.53 with two. With one language the network cannot doubt.
LEAST_CONFIDENCE = 1 / 15


def least_score(languages: int) -> float:
    return 1 / languages + LEAST_CONFIDENCE * (1 - 1 / languages) if languages > 1 else 0.0


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs)
    if model is None:
        return docs.where(arrow.text_column().rlike(r"\p{L}"))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    found = language.languages_of(docs, model, docs.columns).toDF(*names, "lang_pred", "score")
    is_sure = F.col("score") >= least_score(len(model.languages))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & is_sure).select(names).toDF(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_copies.without_copies(docs, keep="largest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    near = near_copies.near_copies(docs)
    return docs.join(near.where("not kept").select("doc_id"), "doc_id", "left_anti").select(*map(arrow.column, docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.where("contaminated").select("doc_id"), "doc_id", "left_anti").select(*map(arrow.column, docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language_stage),
    ("exact_copies", exact_stage),
    ("near_copies", near_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

#: No SQL: a trained network and a packing are not to be had there. Tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each stage's table is in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = session.shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
