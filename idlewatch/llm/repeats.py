"""Removal of long byte strings that occur more than once.

A byte goes if a string of `length` bytes that covers it starts anywhere else, in the same or
another text; overlaps count and matches never cross texts. Strings are found exactly:

1. Each window of `length` bytes names an anchor, its least 32-byte gram by hash. Neighbouring
   windows share anchors, so a text has about one anchor per 85 bytes, with the run of windows
   that name it and a hash of the bytes they cover. Equal windows have equal anchors.
2. Equal anchors with equal runs are repeated as a whole. Of the other runs of a repeated anchor,
   one of each kind goes on, with its text, and their windows are compared by 64-bit hashes. Anchors
   with few kinds are compared in one task each; for those with more than HOT_KINDS (a frequent line
   in ever other surroundings), windows are counted by a shuffle with counts before it.
3. The runs of a text become spans, which are cut out.

Copies meet in step 1 as counts, so a large group of copies is never gathered. This replaces
merging shard Burrows-Wheeler transforms by interleave refinement: see the README.

Null and empty texts have no bytes. Repeated rows are texts of their own, so they remove each
other. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlewatch.llm.common import chunks, mixed, powers, stored

GRAM = 32
#: Kinds of run of one anchor that a task holds at most.
HOT_KINDS = 2000
ANCHORS = "row long, key long, run long, first int, last int"


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes at every place."""
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    n = len(data) - size + 1
    return mixed((sums[size:] - sums[:n]) * down[:n])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mixed((sums[end] - sums[start]) * down[start])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum by prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.concatenate([values, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, length: int):
    """(key, run, first, last): windows first..last name the same anchor."""
    hashes = grams(data, GRAM)
    low = np.uint64(32)
    named = least((hashes >> low) << low | np.arange(len(hashes), dtype=np.uint64), length - GRAM + 1) & np.uint64(0xFFFFFFFF)
    at = named.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    covered = span_hashes(data, first, last + length)
    run = mixed(covered + mixed((at[first] - first).astype(np.uint64)) + (last - first).astype(np.uint64))
    return hashes[at[first]], run, first, last


def numbered(docs: DataFrame) -> DataFrame:
    """A row number that every scan of the same files gives again."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for start, texts in chunks(batch):
                parts = [(start + i, *anchors(np.frombuffer(t, np.uint8), length)) for i, t in enumerate(texts) if len(t) >= length]
                if parts:
                    row = batch["row"].to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([np.full(len(p[1]), row[p[0]]) for p in parts]).astype(np.int64)),
                         *(pa.array(np.concatenate([p[j] for p in parts]).view(np.int64)) for j in (1, 2)),
                         *(pa.array(np.concatenate([p[j] for p in parts]).astype(np.int32)) for j in (3, 4))],
                        names=["row", "key", "run", "first", "last"])

    return rows.select("row", "text").mapInArrow(run, ANCHORS)


def window_rows(wanted: DataFrame, length: int) -> DataFrame:
    """(key, row, first, hashes) from rows with text and the runs to look at."""
    def run(batches):
        for batch in batches:
            out = []
            size = 0
            for text, row, runs in zip(batch["text"], batch["row"].to_pylist(), batch["runs"].to_pylist(), strict=True):
                all_windows = grams(np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8), length)
                for r in runs:
                    blob = all_windows[r["first"] : r["last"] + 1].tobytes()
                    out.append((r["key"], row, r["first"], r["run"], blob))
                    size += len(blob)
                if size > 1 << 22:
                    yield packed(out)
                    out, size = [], 0
            if out:
                yield packed(out)

    def packed(out):
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["key", "row", "first", "run", "windows"])

    return wanted.mapInArrow(run, "key long, row long, first int, run long, windows binary")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(run, key, parts): within each key, the windows that occur more than once."""
    def found(keys, runs, blobs):
        lens = np.array([len(b) // 8 for b in blobs])
        owner = np.repeat(np.arange(len(blobs)), lens)
        within = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        values = np.frombuffer(b"".join(blobs), np.uint64) ^ mixed(np.array(keys, np.int64).view(np.uint64))[owner]
        _, back, counts = np.unique(values, return_inverse=True, return_counts=True)
        on = counts[back] > 1
        owner, within = owner[on], within[on]
        if not len(owner):
            return None
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)])
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(owner)]]) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(keys, np.int64)[owner[begin]]), pa.array(np.array(runs, np.int64)[owner[begin]]),
             pa.array(within[begin].astype(np.int32)), pa.array(within[end].astype(np.int32))], names=["key", "run", "low", "high"])

    def run(batches):
        keys, runs, blobs = [], [], []
        for batch in batches:
            keys += batch["key"].to_pylist()
            runs += batch["run"].to_pylist()
            blobs += batch["windows"].to_pylist()
            cut = len(keys)
            while cut and keys[cut - 1] == keys[-1]:
                cut -= 1
            if cut and (out := found(keys[:cut], runs[:cut], blobs[:cut])):
                yield out
            keys, runs, blobs = keys[cut:], runs[cut:], blobs[cut:]
        if keys and (out := found(keys, runs, blobs)):
            yield out

    return rows.repartition("key").sortWithinPartitions("key").select("key", "run", "windows").mapInArrow(run, "key long, run long, low int, high int")


def repeated_hot_windows(rows: DataFrame) -> DataFrame:
    """The same for anchors with any number of runs: no task holds an anchor, only single runs."""
    def unpacked(batches):
        for batch in batches:
            blobs = batch["windows"].to_pylist()
            lens = np.array([len(b) // 8 for b in blobs], np.int64)
            keys, runs = (np.repeat(batch[c].to_numpy(), lens) for c in ("key", "run"))
            values = np.frombuffer(b"".join(blobs), np.uint64) ^ mixed(keys.view(np.uint64))
            within = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(runs), pa.array(within.astype(np.int32)), pa.array(values.view(np.int64))], names=["key", "run", "at", "window"])

    def spans(batches):
        for batch in batches:
            out = []
            for key, run, at in zip(*(batch[c].to_pylist() for c in ("key", "run", "at")), strict=True):
                at = np.sort(np.array(at, np.int32))
                cut = np.flatnonzero(np.diff(at) > 1)
                out += [(key, run, low, high) for low, high in zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), strict=True)]
            if out:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["key", "run", "low", "high"])

    windows = stored(rows.select("key", "run", "windows").mapInArrow(unpacked, "key long, run long, at int, window long"), "hot-windows")
    twice = stored(windows.groupBy("window").agg(F.count("*").alias("times")).where("times > 1").select("window"), "hot-repeated")
    # A filter by a list without repeats: each row of a window stays or goes, none is multiplied.
    found = windows.join(twice, "window", "left_semi").groupBy("key", "run").agg(F.collect_list("at").alias("at"))
    return found.mapInArrow(spans, "key long, run long, low int, high int")


def removed(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of every row."""
    rows = numbered(docs)
    all_runs = stored(anchor_rows(rows, length), "anchors")
    kinds = all_runs.groupBy("key", "run").agg(F.count("*").alias("times"))
    repeated = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("times").alias("all")).where("all > 1")
    # One row for each kind of run of a repeated anchor; copies are only counted.
    kinds = stored(kinds.join(repeated, "key").select("key", "run", "times", "kinds"), "kinds")
    whole = all_runs.join(kinds.where("times > 1").select("key", "run"), ["key", "run"]).select("row", "first", "last")
    open_kinds = kinds.where("kinds > 1").select("key", "run", (F.col("kinds") > HOT_KINDS).alias("hot"))
    open_runs = stored(all_runs.join(open_kinds, ["key", "run"]), "open-runs")

    def windows(runs):
        chosen = runs.groupBy("key", "run").agg(F.min(F.struct("row", "first", "last")).alias("x")).select("key", "run", "x.*")
        wanted = chosen.groupBy("row").agg(F.collect_list(F.struct("key", "run", "first", "last")).alias("runs"))
        return window_rows(rows.join(wanted, "row").select("row", "text", "runs"), length)

    pieces = stored(repeated_windows(windows(open_runs.where("NOT hot"))), "pieces")
    hot = open_runs.where("hot")
    if not hot.isEmpty():
        pieces = pieces.unionByName(stored(repeated_hot_windows(windows(hot)), "hot-pieces"))
    single = open_runs.join(kinds.where("times = 1").select("key", "run"), ["key", "run"], "left_semi")
    part = single.join(pieces, ["key", "run"]).select("row", (F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last"))
    spans = whole.unionByName(part).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(batch["doc_id"].to_pylist(), batch["text"], batch["spans"].to_pylist(), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                at, kept, n_spans, end = 0, [], 0, -1
                for first, last in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if first > end:
                        kept.append(data[at:first] if end < 0 else data[end:first])
                        n_spans, end = n_spans + 1, last
                    else:
                        end = max(end, last)
                kept.append(data[max(end, 0) :])
                left = b"".join(kept)
                out.append((doc_id, len(data), len(data) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return rows.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(cut, schema)
