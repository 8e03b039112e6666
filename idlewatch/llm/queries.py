"""Registered queries of the text operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from idlewatch.llm import (
    decontamination, exact_copies, filter_audit, lexical, licences, mixing, neighbours, quality, records, repeats, similar_sets, toxicity, wordpieces,
)
from idlewatch.llm.common import table


def op1(spark, sf_dir):
    return similar_sets.near_components(table(spark, sf_dir, "documents"))


def op2(spark, sf_dir):
    return wordpieces.token_counts(table(spark, sf_dir, "documents"), records.vocabulary())


def op3(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4(spark, sf_dir):
    return repeats.removed(table(spark, sf_dir, "documents")).drop("kept")


def op5(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 100 = 0").select("vec_id"))


def op6(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8(spark, sf_dir):
    return mixing.mixed_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op9(spark, sf_dir):
    return records.token_records(spark, table(spark, sf_dir, "documents"), records.vocabulary())


def op10(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"), licences.registry(spark))


def op11(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13(spark, sf_dir):
    return exact_copies.exact_groups(table(spark, sf_dir, "documents"))


def registry() -> dict:
    return {
        "op1_ngram_jaccard_join": (op1, None),
        "op2_token_counts": (op2, None),
        "op3_toxicity": (op3, None),
        "op4_repeated_strings": (op4, None),
        "op5_nearest_neighbours": (op5, None),
        "op6_quality": (op6, None),
        "op7_decontamination": (op7, None),
        "op8_mixing": (op8, mixing.ORACLE.format(docs="documents")),
        "op9_token_records": (op9, None),
        "op10_licences": (op10, None),
        "op11_lexical_search": (op11, lexical.ORACLE),
        "op12_filter_audit": (op12, filter_audit.ORACLE),
        "op13_exact_dedup": (op13, exact_copies.ORACLE),
    }
