"""Exact duplicates by 128-bit content hash (DataFrame functions only).

Texts are equal when they are identical after deleting every character of [\\x20\\x09-\\x0D].
A first pass reduces each text to a narrow row: MD5 and SHA-256 of the normalised text, code
points of the original. Groups of one MD5 value are aggregated from these rows, before the
shuffle in part. A second pass compares bytes: it groups by the hash and the normalised text
itself, partly before the shuffle as well, so a hash that meets two texts shows, and a text with
many copies leaves each task once. The rows of such hashes are grouped by their texts instead.

Of equal texts the one with the most code points stays, then the smallest doc_id; a row without
an id comes after all others. Null counts as an empty text, and all empty texts are equal.
Repeated rows are copies of each other and exactly one row of a group is kept, whatever ids
repeat. An empty table gives no rows. Other columns are not read, or pass through
(`deduplicated`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlewatch.llm.common import joined_by_size, stored


def normalised(text: Column) -> Column:
    """The text without blanks; a null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    for blank in (" ", "\n", "\t", "\r", "\x0b", "\f"):
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def resolved(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with keep_id and keep_row of their group, and its size."""
    best = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    groups = rows.groupBy(*keys).agg(F.count("*").alias("group_size"), best)
    groups = stored(groups.select(*keys, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")), "groups")
    return joined_by_size(rows, groups, keys, "group_size")


def marked(docs: DataFrame) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) of (row, doc_id, text); rows are numbered apart."""
    plain = normalised(F.col("text"))
    narrow = [
        "row", F.col("doc_id").cast("long").alias("doc_id"), content_hash(plain).alias("hash"),
        F.length(F.coalesce("text", F.lit(""))).alias("points"), F.sha2(plain, 256).alias("text_sha256"),
    ]
    rows = stored(docs.select(*narrow), "content-hashes")
    texts = docs.select(content_hash(plain).alias("hash"), plain.alias("plain"))
    clashes = texts.distinct().groupBy("hash").agg(F.count("*").alias("texts")).where("texts > 1").select("hash")
    clashes = stored(clashes, "hash-clashes")
    if clashes.isEmpty():
        found = resolved(rows, ["hash"])
    else:
        apart = stored(docs.select(*narrow, plain.alias("plain")).join(clashes, "hash", "left_semi"), "clashing-texts")
        found = resolved(rows.join(clashes, "hash", "left_anti"), ["hash"]).unionByName(resolved(apart, ["hash", "plain"]).drop("plain"))
    return found.select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row", F.monotonically_increasing_id())


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of (doc_id, text)."""
    return marked(numbered(docs.select("doc_id", "text"))).drop("row")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; the table is written once, to number its rows."""
    whole = stored(numbered(docs.select(F.struct("*").alias("doc"))), "numbered-documents")
    marks = marked(whole.select("row", "doc.doc_id", "doc.text"))
    return whole.join(marks.where("kept").select("row"), "row", "left_semi").select("doc.*")


ORACLE = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(plain) AS text_sha256 FROM n
WINDOW w AS (PARTITION BY plain ORDER BY points DESC, doc_id NULLS LAST)
"""
