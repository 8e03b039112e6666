"""Filter interaction audit against SQL and a plain evaluation of every order."""

import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from idlewatch.llm import filter_audit, queries
from idlewatch.llm.common import table
from tests.llm.test_operators import none, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain_failed(rows):
    least = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, part, text in rows:
        text = text or ""
        words = WORD.findall(text)
        tests = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), doc_id is not None and doc_id > least[text])
        yield doc_id, part or "", "".join(f for f, bad in zip("ABCDE", tests, strict=True) if bad)


def plain_audit(rows, good, toxic):
    out, shapley = {}, Counter()
    for doc_id, part, failed in plain_failed(rows):
        for order in map("".join, permutations("ABCDE")):
            first = next((s for s, f in enumerate(order) if f in failed), 5)
            for step, letter in enumerate(order):
                counts = out.setdefault((part, order, step + 1), [0] * 6)
                here = first == step
                counts[:] = np.add(counts, [first > step, here, first < step and letter in failed, failed == letter,
                                            here and doc_id in good, here and doc_id in toxic])
            if first < 5:
                shapley[part, order[first]] += 1
    return sorted((*k, *map(int, v), shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def audited(docs, labels):
    return sorted((r.part, r.filter_order, r.step, *(r[c] for c in COLUMNS)) for r in filter_audit.audit(docs, labels).collect())


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("which", ["odd", "none"])
def test_audit_of_odd_rows(spark, odd, none, which, small, monkeypatch):  # noqa: F811
    """Also with shards of one document and texts read in slices of a hundred bytes."""
    if small:
        monkeypatch.setattr(filter_audit, "CHUNK", 100)
        monkeypatch.setattr(filter_audit, "SHARD_BYTES", 1)
    docs = {"odd": odd, "none": none}[which]
    marks = [(i, i % 2, int(i % 3 == 0)) for i in range(10)] + [(3, 0, None), (4, None, None), (None, 1, 1), (5, 7, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    good, toxic = ({m[0] for m in marks if m[c] == 1} - {None} for c in (1, 2))
    assert audited(docs, labels) == plain_audit(rows, good, toxic)


def test_audit_matches_sql(spark, sf_dir):
    query, sql = queries.registry()["op12_filter_audit"]
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    columns = ("part", "filter_order", "step", *COLUMNS)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in query(spark, sf_dir).collect()) == sorted(want)


@pytest.mark.parametrize("buckets", [3, 4096])
def test_matrix_holds_every_word_under_one_number(spark, odd, buckets, monkeypatch):  # noqa: F811
    monkeypatch.setattr(filter_audit, "BUCKETS", buckets)
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 300)
    shards, known = filter_audit.term_matrix(odd)
    words = {r.id: bytes(r.word) for r in known.collect()}
    assert len(set(words.values())) == len(words) == known.count()
    found = []
    for r in shards.collect():
        ends = np.frombuffer(r.indptr, np.int64)
        data, ids = (filter_audit.widened(x, int(ends[-1])) for x in (r.data, r.indices))
        for i, doc_id in enumerate(r.doc_ids):
            part = slice(ends[i], ends[i + 1])
            found.append((str(doc_id), sorted((words[int(w)], int(n)) for w, n in zip(ids[part], data[part], strict=True))))
    want = [(str(r.doc_id), sorted(Counter((r.text or "").encode().split()).items())) for r in odd.collect()]
    assert sorted(found) == sorted(want)


def test_slices_end_at_blanks():
    for data in (b"", b"a" * 40, b"one two  three four", b" " * 20, b"abc " * 9 + b"x" * 30 + b" y\tz\n" * 5, b"12345678 " * 3):
        parts = list(filter_audit.pieces(data, 7))
        assert b"".join(parts) == data and [w for p in parts for w in p.split()] == data.split()
