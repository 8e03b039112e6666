"""Licence scans by canonical digest lookup (DataFrame functions only).

A text is normalised (case, copyright lines, spellings held equal, punctuation, white
space) and its SHA-256 is joined with the digests of known licence texts. The whole text
must be the licence; the same is tried for each of its lines, so that notices in a document
are found. The registry is a parameter of (licence, text) rows, normalised alike; `registry` gives
the whole texts and headers of `licence_texts` (licence name, then a variant after "--") and notices.

Null and empty texts match nothing. Repeated rows each get their row; extra columns are
not read. One row per document, licences sorted.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idlewatch.llm.common import stored

# Whole texts, short notices, and spellings held equal.
TEXTS = Path(__file__).with_name("licence_texts")
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
)
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"),
             ("non-commercial", "noncommercial"), ("per cent", "percent"), ("copyright holder", "copyright owner"))


def cleaned(text: Column) -> Column:
    """All of the normal form that looks at one line at a time; line feeds stay."""
    text = F.regexp_replace(F.lower(text), r"(?m)^[^\S\n]*(copyright\b|\(c\)|©)[^\n]*$", " ")
    for found, put in SPELLINGS:
        text = F.regexp_replace(text, rf"\b{found}", put)
    return F.regexp_replace(text, r"[^\p{L}\p{N}\s]+", " ")


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalised(text: Column) -> Column:
    return spaced(cleaned(text))


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def registry(spark: SparkSession) -> DataFrame:
    whole = [(path.stem.split("--")[0], path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]
    return spark.createDataFrame([*KNOWN, *whole], "licence string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest of the whole text, whole_text licence, licences by line (sorted)."""
    names = known.withColumn("_normal", normalised(F.col("text"))).where("_normal != ''")
    names = stored(names.select(F.sha2("_normal", 256).alias("_digest"), "licence").distinct(), "licence-digests")
    text = F.coalesce("text", F.lit(""))
    told = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), text.alias("text"))
    # The whole text is cleaned once; its lines are then the normal forms of the lines.
    told = told.select("doc_id", "_row", cleaned(F.col("text")).alias("_clean"))
    each = F.when(F.instr("_clean", "\n") > 0, F.concat(F.array("_clean"), F.split("_clean", "\n"))).otherwise(F.array("_clean"))
    pieces = told.select("_row", F.explode(each).alias("_piece")).select("_row", spaced(F.col("_piece")).alias("_piece"))
    pieces = pieces.where("_piece != ''").select("_row", F.sha2("_piece", 256).alias("_digest"))
    told = told.select("doc_id", "_row", F.sha2(spaced(F.col("_clean")), 256).alias("digest"))
    found = pieces.join(names, "_digest").groupBy("_row").agg(F.array_sort(F.collect_set("licence")).alias("licences"))
    whole = names.groupBy("_digest").agg(F.min("licence").alias("whole_text"))
    return (
        told.join(found, "_row", "left").join(whole, F.col("digest") == F.col("_digest"), "left")
        .select("doc_id", "digest", "whole_text", F.coalesce(F.array_join("licences", ","), F.lit("")).alias("licences"))
    )
