"""The corpus pipeline: toxicity, near duplicates, decontamination, mixture, token records.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of documents; the last returns one row per written record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm import decontamination, mixing, records, similar_sets, toxicity
from idlewatch.llm.common import stored, table


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among the ids; those without an id stay."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark, docs, sf_dir):
    scores = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    return without(docs, scores.where("predicted = 1"))


def drop_near_duplicates(spark, docs, sf_dir):
    """The smallest id of each component stays, and the rows without an id."""
    groups = similar_sets.near_components(docs, degrees=False)
    kept = without(docs, groups.where("doc_id != component_id"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    return kept.withColumn("_place", place).where("_place = 1 OR doc_id IS NULL").select(*docs.columns)


def drop_contaminated(spark, docs, sf_dir):
    return without(docs, decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark, docs, sf_dir):
    return mixing.mixture(docs)


def write_tokens(spark, docs, sf_dir):
    return records.token_records(spark, docs, records.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("token_records", write_tokens),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
