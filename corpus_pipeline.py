"""A training corpus from raw documents: filter, dedupe, decontaminate, mix, write token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's documents. All stages but the last return the columns of ``docs``.

* ``toxicity``: documents predicted toxic go.
* ``near_duplicates``: one document of each group of near copies stays, that with the smallest id.
* ``decontamination``: documents that hold a passage of the benchmark go.
* ``mixing``: sources are mixed to their target weights; a document has one row for each pass over it.
* ``token_files``: token files are written and read back; one row per stored document.

Edge cases are those of the operators: null and empty texts pass the filters, are taken zero times by the mix, and
so have no row after it; null ids and other columns pass through; empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.decontaminate import decontaminated
from rowmill.llm.mixing import mixed_documents
from rowmill.llm.near_duplicates import without_near_duplicates
from rowmill.llm.repair import read_token_files, write_token_files
from rowmill.llm.tables import table
from rowmill.llm.toxicity import fit_toxicity, not_toxic, sample_labelled
from rowmill.session import ship_package
from rowmill.storage import materialize, new_path


def filter_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = fit_toxicity(sample_labelled(docs, table(spark, sf_dir, "labels")))
    return not_toxic(docs, model)


def filter_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return without_near_duplicates(docs)


def filter_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = new_path(spark, "token-files")
    write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


STAGES = [
    ("toxicity", filter_toxicity),
    ("near_duplicates", filter_near_duplicates),
    ("decontamination", filter_benchmark),
    ("mixing", mix_sources),
    ("token_files", token_files),
]

#: A fitted model, a graph search and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
