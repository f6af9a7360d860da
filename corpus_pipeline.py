"""The corpus pipeline: five training-data stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the shared folder and
reads again for the next.  All but the last return the columns of docs, whatever these are.

1. quality rules: failed lines go from the texts, and rejected documents go;
2. n-gram Jaccard join: one document of each group of near copies stays, that with the smallest id;
3. benchmark decontamination: documents with a word inside a benchmark window go;
4. PII: every span found is replaced by its kind;
5. BPE: adds n_tokens and token_ids, and the text is what the ids decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import bpe, decontaminate, jaccard, pii, quality
from newsloom.llm.common import Scratch, table, tune
from newsloom.llm.queries import byte_bpe

#: SQL can't express the span classifier, nor byte-pair merging.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return quality.clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return jaccard.deduplicate(docs, Scratch(spark, "pipeline-jaccard"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return bpe.tokenize(docs, byte_bpe())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", byte_pairs),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
