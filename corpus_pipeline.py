"""A training corpus from ``documents``: quality rules, toxicity, near duplicates, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``documents``, and any others that come with them, as they are.

Null texts count as empty (quality rules reject them for their length); null ids and sources are values like others; repeated rows are rows of their own; of
near duplicates with equal ids the first by row number stays; an empty table gives an empty result; a very long text is worked on whole by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import toxicity as tox
from docloom.llm.best_fit_packing import best_fit_packing
from docloom.llm.common import materialize, table
from docloom.llm.ngram_join import keep_first
from docloom.llm.quality_rules import apply_quality_rules
from docloom.llm.suffix_dedup import apply_suffix_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits go from the others."""
    return apply_quality_rules(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score at the threshold or above go."""
    return tox.drop_toxic(docs, tox.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return keep_first(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes or more that occur twice or more go from the texts."""
    return apply_suffix_dedup(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets."""
    import public_tokenizers

    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("best_fit_packing", packing),
]

#: Byte strings, trained scores and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
