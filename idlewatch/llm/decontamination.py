"""Benchmark decontamination: item-sized windows by shared shingles, then exact similarity.

A document is tested against an item where it holds enough of the item's shingles (without
them the similarity cannot reach the threshold). The windows of the item's number of words
around those shingles are verified if enough of them fall inside: weighted Jaccard similarity of
five-word shingles, at least 0.75. No window that reaches it is missed; a multi-index Hamming search
over SimHash fingerprints would miss some (see the README), so none is used.
Items with fewer than five words must occur as they stand.

The benchmark is taken in blocks of ITEMS items, each broadcast; documents are never gathered.
Null and empty documents and items match nothing. Of tied windows the first counts. Repeated
rows are reported each; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlewatch.llm.common import chunks, shingle_hashes, word_hashes

K, ITEMS = 5, 5000
OUT = "doc_id long, item_id long, similarity double, word_start int, n_words int"


def weighted(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


class Benchmark:
    def __init__(self, items: list[tuple[int, bytes]], threshold: float):
        self.threshold = threshold
        self.items, self.of, self.short = [], {}, {}
        for item_id, text in items:
            words, owner = word_hashes([text])
            if not len(words):
                continue
            shingles, _ = shingle_hashes(words, owner, min(K, len(words)), 1)
            if len(words) < K:
                self.short.setdefault(len(words), {}).setdefault(int(shingles[0]), []).append(item_id)
                continue
            n = len(self.items)
            self.items.append((item_id, len(words), Counter(shingles.tolist())))
            for h in set(shingles.tolist()):
                self.of.setdefault(h, []).append(n)
        self.hashes = np.array(sorted(self.of), np.uint64)

    def found(self, words: np.ndarray):
        """(item_id, similarity, first word, words) of one document."""
        owner = np.zeros(len(words), np.int64)
        for length, known in self.short.items():
            if len(words) >= length:
                hashes, _ = shingle_hashes(words, owner, length, 1)
                where = np.flatnonzero(np.isin(hashes, np.array(list(known), np.uint64)))
                seen = set()
                for p in where.tolist():
                    for item_id in known[int(hashes[p])]:
                        if item_id not in seen:
                            seen.add(item_id)
                            yield item_id, 1.0, p, length
        if len(words) < K or not len(self.hashes):
            return
        hashes, _ = shingle_hashes(words, owner, K, 1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        places: dict[int, list[int]] = {}
        for p in np.flatnonzero(self.hashes[at] == hashes).tolist():
            for n in self.of[int(hashes[p])]:
                places.setdefault(n, []).append(p)
        for n, spots in places.items():
            item_id, length, bag = self.items[n]
            size = length - K + 1
            # With J >= t and bags of sizes a <= size and size: the overlap is at least t * size.
            if sum(min(c, bag[h]) for h, c in Counter(hashes[spots].tolist()).items()) < self.threshold * size:
                continue
            best, tried = None, set()
            for p in spots:
                for s in range(max(0, p - size + 1), min(p, max(0, len(hashes) - size)) + 1):
                    if s in tried:
                        continue
                    tried.add(s)
                    window = hashes[s : s + size]
                    inside = sum(1 for q in spots if s <= q < s + size)
                    if inside < self.threshold * size:
                        continue
                    got = weighted(Counter(window.tolist()), bag)
                    if got >= self.threshold and (best is None or got > best[0] or got == best[0] and s < best[1]):
                        best = got, s
            if best:
                yield item_id, best[0], best[1], min(length, len(words) - best[1])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, block: int = ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, word_start, n_words of every contaminated document and item."""
    spark = docs.sparkSession
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // block))
    out = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").collect()
        known = spark.sparkContext.broadcast(Benchmark([(r["item_id"], r["text"].encode()) for r in rows], threshold))

        def run(batches, known=known):
            for batch in batches:
                rows = []
                for first, texts in chunks(batch):
                    words, owner = word_hashes(texts)
                    parts = np.split(words, np.searchsorted(owner, np.arange(1, len(texts))))
                    for i, part in enumerate(parts):
                        doc_id = batch["doc_id"][first + i].as_py()
                        rows += [(doc_id, *x) for x in known.value.found(part)]
                cols = list(zip(*rows, strict=True)) if rows else [()] * 5
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "item_id", "similarity", "word_start", "n_words"])

        part = told.mapInArrow(run, OUT)
        out = part if out is None else out.unionByName(part)
    return out
