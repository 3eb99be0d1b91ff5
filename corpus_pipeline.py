"""The document pipeline: language ID, quality rules, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; between stages the documents are
written as Parquet to the shared folder and read again, so a lost executor repeats part of one stage at most. What a stage
has stored for itself, and the documents before it, are removed once its own are written. All stages but the last return
the columns of documents as they are, whatever else is among them; the last returns the packed pieces with their token ids.

Defined results: a null or empty text, or one without a letter, goes in the first stage; a null id stays, and has nothing to
resemble; a null language or source is a value like any other; of rows with equal id and text one stays; different texts
with one id are documents of their own; a text of any length is worked on whole; an empty table gives no rows.
No SQL can express the trained network or the tokeniser, so ORACLE_SQL is None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm.common import discard, materialise, scratch, table
from scriptorium.llm.jaccard import near_duplicate_stage
from scriptorium.llm.langid import language_stage
from scriptorium.llm.packing import packing_stage
from scriptorium.llm.quality import quality_stage

STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as keep:
            kept = keep(materialise(stage(spark, docs, sf_dir), name))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
