"""Exact duplicates against SQL and a plain grouping, with hashes that clash and groups that are hot."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from idlewatch.llm import common, exact_copies, queries
from idlewatch.llm.common import table
from tests.llm.test_operators import none, odd  # noqa: F401

BLANK = str.maketrans("", "", " \t\n\x0b\f\r")


def plain_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(BLANK), []).append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for plain, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(m[2], members[0][2], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, exact_copies.exact_groups(docs).collect()), key=str)


@pytest.mark.parametrize(
    "which, digits, hot",
    [("odd", 32, 2000), ("odd", 2, 2), ("odd", 0, 2), ("none", 32, 2), ("none", 0, 2000), ("sf", 32, 2), ("sf", 2, 2000)],
)
def test_groups(spark, sf_dir, odd, none, which, digits, hot, monkeypatch):  # noqa: F811
    """Also with hashes of eight bits and of none, where different texts share a hash, and with hot groups."""
    monkeypatch.setattr(common, "HOT", hot)
    monkeypatch.setattr(exact_copies, "content_hash", lambda text: F.unhex(F.substring(F.md5(text), 1, digits)))
    docs = {"odd": odd, "none": none, "sf": table(spark, sf_dir, "documents")}[which]
    assert found(docs) == plain_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_sql(spark, sf_dir):
    query, sql = queries.registry()["op13_exact_dedup"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(map(tuple, query(spark, sf_dir).collect())) == sorted(con.execute(sql).fetchall())


def test_blanks_length_and_ties(spark):
    rows = [(5, "a b"), (4, "ab"), (9, "a\x0b\tb"), (2, "é \U0001f600"), (3, "é  \U0001f600"), (7, "a b"), (1, None), (0, " "), (8, "A B")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_copies.exact_groups(docs).collect()}
    assert got == {5: (9, 3, False), 4: (9, 3, False), 9: (9, 3, True), 2: (3, 2, False), 3: (3, 2, True), 7: (7, 1, True),
                   1: (0, 2, False), 0: (0, 2, True), 8: (8, 1, True)}


def test_deduplicated_keeps_one_whole_row_of_each_group(spark, odd, none):  # noqa: F811
    """Columns named like the operator's own pass through."""
    docs = odd.withColumn("hash", F.lit(1)).withColumn("doc", F.lit("d")).withColumn("kept", F.lit(7))
    kept = exact_copies.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = {(r.text or "").translate(BLANK) for r in docs.collect()}
    assert sorted((r.text or "").translate(BLANK) for r in rows) == sorted(texts) and {r.kept for r in rows} == {7}
    assert exact_copies.deduplicated(none).count() == 0
