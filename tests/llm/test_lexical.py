"""Ranked lexical search against SQL and a plain scoring of all documents."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from idlewatch.llm import lexical, queries
from idlewatch.llm.common import table
from tests.llm.test_operators import none, odd  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items, k=50):
    bags = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, bag in bags:
            m = 50 + 50 * bag.total() * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                        for t in terms if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, i + 1, None if null else doc_id, -score) for i, (score, null, doc_id) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(docs, items, k=50):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(docs, items, k).collect()), key=str)


ITEMS = [(1, "The quick BROWN fox; jumps!"), (2, ""), (3, None), (4, "x" * 500 + " ab"), (5, "nowhere-to-be found"), (None, "river house"),
         (1, "apache licence version 2"), (6, "é" * 250), (7, "a b c d e")]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows(spark, odd, none, which, small, monkeypatch):  # noqa: F811
    """Also with shards of two documents, texts in slices, one interval at a time and blocks of few terms."""
    if small:
        for name, value in {"SHARD_DOCS": 2, "CHUNK": 60, "WIDTH": 1, "BLOCK_TERMS": 4}.items():
            monkeypatch.setattr(lexical, name, value)
    docs = {"odd": odd, "none": none}[which].withColumnRenamed("key", "term").withColumnRenamed("row", "shard")
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for k in (50, 3):
        assert found(docs, items, k) == plain_ranking(rows, ITEMS, k)
    assert found(docs, items.limit(0)) == []


def test_sql(spark, sf_dir):
    query, sql = queries.registry()["op11_lexical_search"]
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({sql})").fetchall()
    assert want and sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in query(spark, sf_dir).collect()) == sorted(want)


def lists_of(rng, n_docs, n_terms):
    out = []
    for t in range(n_terms):
        docs = np.flatnonzero(rng.random(n_docs) < rng.choice([0.02, 0.3, 0.9])).astype(np.uint32)
        if len(docs):
            out.append((b"t%d" % t, int(rng.integers(1, 9)), docs, rng.integers(1, 4, len(docs)).astype(np.uint32)))
    return out


@pytest.mark.parametrize("width", [1, 4, 256])
def test_search_equals_scoring_all_with_ties(width, monkeypatch):
    """Few distinct scores, so most ranks are decided by ids, which do not follow the order of documents."""
    monkeypatch.setattr(lexical, "WIDTH", width)
    rng = np.random.default_rng(width)
    for n_docs in (1, 7, 300):
        lengths = rng.integers(1, 4, n_docs)
        shard = lexical.Shard(lists := lists_of(rng, n_docs, 12) or [(b"t", 1, np.zeros(1, np.uint32), np.ones(1, np.uint32))], lengths, n_docs, int(lengths.sum()))
        ids, nulls = rng.permutation(n_docs), (rng.random(n_docs) < 0.1).astype(np.uint8)
        scores = np.zeros(n_docs, np.int64)
        np.add.at(scores, shard.docs, shard.impacts)
        best = lexical.Best(10)
        best.enter(ids, nulls)
        shard.search([x[0] for x in lists], best)
        want = [i for i in np.lexsort((ids, nulls, -scores)) if scores[i] > 0][:10]
        assert best.scores.tolist() == scores[want].tolist() and best.ids.tolist() == ids[want].tolist()


def test_search_leaves_documents_out_by_their_bounds(monkeypatch):
    """A rare heavy term in few documents: the common ones of the others are never scored one by one."""
    scored = []
    plain = lexical.Best.offer
    monkeypatch.setattr(lexical.Best, "offer", lambda self, docs, scores: (scored.append(len(docs)), plain(self, docs, scores))[1])
    monkeypatch.setattr(lexical, "WIDTH", 1)
    n = 5000
    lists = [(b"common", 1, np.arange(n, dtype=np.uint32), np.ones(n, np.uint32)), (b"rare", 900, np.arange(0, n, 100, dtype=np.uint32), np.ones(50, np.uint32))]
    best = lexical.Best(20)
    best.enter(np.arange(n), np.zeros(n, np.uint8))
    lexical.Shard(lists, np.full(n, 9), n, 9 * n).search([b"common", b"rare"], best)
    assert best.ids.tolist() == list(range(0, 2000, 100)) and sum(scored) < 300


def test_logarithms():
    n = np.arange(1, 5000)
    assert lexical.log2(n).tolist() == [int(x).bit_length() - 1 for x in n]
