"""Ranked lexical search: best-first document intervals bounded by range maxima of posting lists.

Terms are the maximal runs of ASCII letters and digits and of characters beyond ASCII in the whole
text, only A-Z lower-cased. N documents have a term, L is the number of all terms, n that of one
document, df and tf as usual; w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + 50 n N div L, and a
document scores the sum of w * (10^9 tf div (1000 tf + 20 m)) over the item's terms.

The index is a table of shards of about 16 MB of text: one row per shard and term holds a posting
list (documents in order, frequencies), one row per shard its doc_ids and lengths. Items are
searched in blocks of bounded size. A block's terms pick their lists in Spark; lists of a shard
meet in one task, which holds one shard at a time:

* A sparse table over each list gives the position of the largest impact in any range.
* An interval of documents is bounded by the sum of its terms' range maxima. The intervals with the
  highest bounds are taken first, some at a time; each is split at the document of its largest
  single impact, that document is scored exactly, and both sides are bounded by the tables again.
* Intervals whose bound is below the item's k-th best score so far (over all shards the task has
  seen) are dropped. The search ends when none is left, so no document is missed.

Each task yields its k best documents per item, the best of all are ranked at the end.

Null text: no terms, never found. Repeated rows are documents of their own. Items of one item_id
are one item with the terms of all its rows (a null id is an item too); an item without a known
term finds nothing. Equal scores rank by ascending doc_id, null last. Empty tables give no rows.
Other columns are not read. The terms of one item have to fit in memory, as the block does.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import CHUNK, stored

SHARD_BYTES, SHARD_DOCS = 1 << 24, 1 << 16
#: Item terms of a block on average; this bounds what is broadcast.
BLOCK_TERMS = 200_000
#: Intervals split at a time, at most.
WIDTH = 256
INDEX = "shard bigint, term binary, n_docs bigint, n_terms bigint, docs binary, counts binary, nulls binary"
FOUND = "item int, doc_id bigint, score bigint"

#: Bytes of terms, A-Z lower-cased, all others as blanks.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def term_counts(text: str, chunk: int = CHUNK) -> Counter:
    data = text.encode().translate(TERM_BYTES)
    counts: Counter = Counter()
    at = 0
    while len(data) - at > chunk:
        end = data.rfind(b" ", at + 1, at + chunk)
        end = data.find(b" ", at + 1) if end < 0 else end
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    counts.update(data[at:].split())
    return counts


class Postings:
    """Posting lists of consecutive documents."""

    def __init__(self) -> None:
        self.numbers: defaultdict = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.lengths, self.terms, self.counts, self.size = [], [], [], [], 0

    def add(self, doc_id, text: str, chunk: int) -> None:
        counts = term_counts(text, chunk)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.terms.append(np.fromiter(map(self.numbers.__getitem__, counts), np.int64, len(counts)))
        self.counts.append(np.fromiter(counts.values(), np.uint32, len(counts)))
        self.size += len(text) + 64

    def batch(self, shard: int) -> pa.RecordBatch:
        """The row of the documents (term null), then one row per term."""
        owner = np.repeat(np.arange(len(self.ids), dtype=np.uint32), [len(t) for t in self.terms])
        terms = np.concatenate(self.terms)
        order = np.argsort(terms, kind="stable")
        sizes = np.bincount(terms, minlength=len(self.numbers)).astype(np.int64)
        nulls = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        lengths = np.array(self.lengths, np.int64)
        head = [shard, None, int((lengths > 0).sum()), int(lengths.sum()), ids.tobytes(), lengths.tobytes(), nulls.tobytes()]
        rows = len(sizes)
        ends = pa.py_buffer(np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes) * 4]).astype(np.int32))

        def lists(values: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), rows, [None, ends, pa.py_buffer(values[order])])

        body = [
            pa.array(np.full(rows, shard)), pa.array(list(self.numbers), pa.binary()), pa.array(sizes), pa.nulls(rows, pa.int64()),
            lists(owner), lists(np.concatenate(self.counts)), pa.nulls(rows, pa.binary()),
        ]
        names = [f.split()[0] for f in INDEX.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array([h], b.type), b]) for h, b in zip(head, body, strict=True)], names=names
        )


def built_index(docs: DataFrame) -> DataFrame:
    """The index over all documents, written to the shared folder."""
    limits, chunk = (SHARD_BYTES, SHARD_DOCS), CHUNK

    def run(batches):
        made, shard = 0, Postings()
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                shard.add(doc_id.as_py(), text.as_py() or "", chunk)
                if shard.size >= limits[0] or len(shard.ids) >= limits[1]:
                    yield shard.batch(first + made)
                    made, shard = made + 1, Postings()
        if shard.ids:
            yield shard.batch(first + made)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)
    return stored(rows, "lexical-index", "zstd")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                terms = list(term_counts(text.as_py() or ""))
                ids = pa.concat_arrays([batch["item_id"].slice(i, 1)] * len(terms)) if terms else batch["item_id"].slice(0, 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary())], names=["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary").distinct()


LOG2 = np.zeros(2, np.int8)


def log2(n: np.ndarray) -> np.ndarray:
    """Rounded down, of numbers from 1."""
    global LOG2
    most = int(n.max()) + 1 if len(n) else 1
    if len(LOG2) < most:
        LOG2 = np.repeat(np.arange(most.bit_length() + 1, dtype=np.int8), [1, *(1 << i for i in range(most.bit_length()))])
        LOG2 = np.maximum(LOG2 - 1, 0).astype(np.int8)
    return LOG2[n]


class Shard:
    """Posting lists of one shard with their impacts and sparse tables."""

    def __init__(self, lists: list, lengths: np.ndarray, n_docs: int, n_terms: int) -> None:
        """lists: (term, weight, documents, frequencies)."""
        self.places = {x[0]: i for i, x in enumerate(lists)}
        sizes = np.array([len(x[2]) for x in lists], np.int64)
        self.ends = np.cumsum(sizes).astype(np.int32)
        self.starts = (self.ends - sizes).astype(np.int32)
        self.docs = np.concatenate([x[2] for x in lists]).astype(np.int64)
        counts = np.concatenate([x[3] for x in lists]).astype(np.int64)
        weights = np.repeat(np.array([x[1] for x in lists], np.int64), sizes)
        m = 50 + 50 * lengths * n_docs // n_terms
        self.impacts = weights * (10**9 * counts // (1000 * counts + 20 * m[self.docs]))
        self.width = len(lengths)
        self.keys = np.repeat(np.arange(len(lists)), sizes) * self.width + self.docs
        # Row j: the position of the largest impact among 2^j of the list from here on.
        table, step = [np.arange(len(self.docs), dtype=np.int32)], 1
        while 2 * step <= sizes.max():
            a, b = table[-1][:-step], table[-1][step:]
            row = table[-1].copy()
            row[:-step] = np.where(self.impacts[a] >= self.impacts[b], a, b)
            table.append(row)
            step *= 2
        self.table = np.array(table)

    def maxima(self, low: np.ndarray, high: np.ndarray):
        """Positions of the largest impacts of the ranges, and the sums of these impacts by interval."""
        some = low < high
        a, b = low[some], high[some]
        level = log2(b - a).astype(np.int64)
        left, right = self.table[level, a], self.table[level, b - (1 << level)]
        at = np.where(self.impacts[left] >= self.impacts[right], left, right)
        places, values = np.zeros(low.shape, np.int32), np.zeros(low.shape, np.int64)
        places[some], values[some] = at, self.impacts[at]
        return places, values.sum(axis=1)

    def search(self, terms: list, best: Best) -> None:
        """Offer every document that may be among the best; `terms` are those of one item."""
        lists = np.array([self.places[t] for t in terms if t in self.places], np.int64)
        if not len(lists):
            return
        low, high = self.starts[lists][None], self.ends[lists][None]
        places, bounds = self.maxima(low, high)
        width = max(1, WIDTH * 64 // max(64, len(lists)))
        while True:
            # A document below the k-th best is out; one that equals it may win by its id.
            keep = bounds >= best.least
            low, high, places, bounds = low[keep], high[keep], places[keep], bounds[keep]
            if not len(bounds):
                return
            first = np.argpartition(-bounds, width - 1)[:width] if len(bounds) > width else np.arange(len(bounds))
            rest = np.ones(len(bounds), bool)
            rest[first] = False
            a, b, at = low[first], high[first], places[first]
            some = a < b
            largest = np.where(some, self.impacts[at], -1).argmax(axis=1)
            doc = self.docs[at[np.arange(len(first)), largest]][:, None]
            cut = a.copy()
            cut[some] = np.searchsorted(self.keys, (lists * self.width + doc)[some])
            held = some & (cut < b)
            held[held] = self.docs[cut[held]] == np.broadcast_to(doc, a.shape)[held]
            scores = np.where(held, self.impacts[np.where(held, cut, 0)], 0).sum(axis=1)
            best.offer(doc[:, 0], scores)
            new_low, new_high = np.concatenate([a, cut + held]), np.concatenate([cut, b])
            new_places, new_bounds = self.maxima(new_low, new_high)
            good = new_bounds >= best.least
            low, high = np.concatenate([low[rest], new_low[good]]), np.concatenate([high[rest], new_high[good]])
            places, bounds = np.concatenate([places[rest], new_places[good]]), np.concatenate([bounds[rest], new_bounds[good]])


class Best:
    """The k best documents of one item: score descending, id ascending, null last."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def enter(self, ids: np.ndarray, nulls: np.ndarray) -> None:
        """The documents of the shard that is searched next."""
        self.shard = ids, nulls

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores = np.concatenate([self.scores, scores[good]])
        ids, nulls = (np.concatenate([old, new[docs[good]]]) for old, new in zip((self.ids, self.nulls), self.shard, strict=True))
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def by_shard(batches):
    """(row of the documents, rows of terms) of each shard; rows come sorted by shard, then term, null first."""
    head, lists = None, []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("shard", "term", "weight", "docs", "counts", "nulls")]
        for shard, term, weight, docs, counts, nulls in zip(*columns, strict=True):
            if term is None:
                if lists:
                    yield head, lists
                head, lists = (np.frombuffer(docs, np.int64), np.frombuffer(counts, np.int64), np.frombuffer(nulls, np.uint8)), []
            else:
                lists.append((bytes(term), weight, np.frombuffer(docs, np.uint32), np.frombuffer(counts, np.uint32)))
    if lists:
        yield head, lists


def searched(index: DataFrame, weights: DataFrame, items: dict[int, list], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of every item by task. `weights`: (term, weight), bounded."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        best = {item: Best(k) for item in shared.value}
        for (ids, lengths, nulls), lists in by_shard(batches):
            shard = Shard(lists, lengths, n_docs, n_terms)
            for item, terms in shared.value.items():
                best[item].enter(ids, nulls)
                shard.search(terms, best[item])
        for item, found in best.items():
            if len(found.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.scores), item, np.int32)), pa.array(found.ids, mask=found.nulls.astype(bool)), pa.array(found.scores)],
                    names=["item", "doc_id", "score"],
                )

    columns = ("shard", "term", "weight", "docs", "counts", "nulls")
    heads = index.where("term IS NULL").withColumn("weight", F.lit(None).cast("long"))
    lists = index.where("term IS NOT NULL").join(F.broadcast(weights), "term")
    rows = heads.select(*columns).unionByName(lists.select(*columns))
    return rows.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first()).mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item."""
    index = built_index(docs)
    terms = stored(item_terms(items), "item-terms")
    totals = index.where("term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = totals["n"] or 0, totals["l"] or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight")
    used = index.where("term IS NOT NULL").join(terms.select("term").distinct(), "term", "left_semi")
    weights = stored(used.groupBy("term").agg(F.sum("n_docs").alias("df")).select("term", weight).where("weight > 0"), "weights")
    kind = items.schema["item_id"].dataType.simpleString()
    blocks = max(1, math.ceil(terms.count() / BLOCK_TERMS))
    terms = terms.join(weights.select("term"), "term").withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = []
    for block in range(blocks):
        mine = terms.where(F.col("block") == block)
        groups = mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()  # bounded by the block
        if not groups:
            continue
        found = searched(
            index, weights.join(mine.select("term").distinct(), "term", "left_semi"),
            {i: [bytes(t) for t in g["terms"]] for i, g in enumerate(groups)}, n_docs, n_terms, k,
        )
        known = index.sparkSession.createDataFrame([(i, g["item_id"]) for i, g in enumerate(groups)], f"item int, item_id {kind}")
        out.append(stored(found.join(F.broadcast(known), "item").select("item_id", "doc_id", "score"), "found"))
    if not out:
        return terms.where("false").selectExpr("item_id", "1 AS rank", "0L AS doc_id", "0L AS score")
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
p AS (SELECT place, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
t AS (SELECT place, doc_id, n, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM t CROSS JOIN g GROUP BY term, n_docs),
s AS (SELECT i.item_id, place, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM t JOIN w USING (term) JOIN i USING (term) CROSS JOIN g GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
