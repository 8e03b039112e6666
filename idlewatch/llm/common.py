"""Helpers shared by the text operators: tables, shared storage, word and shingle hashes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idlewatch.session import shared_folder

WORDS = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 20
ONE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder; no two runs meet in it."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: lineage ends, lost executors cost nothing."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key with more than one in so many rows is hot; there are fewer hot keys than this.
HOT = 2000


def joined_by_size(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """The rows with the columns of their group; `groups` counts all rows by non-null keys in `size`.

    Rows of hot keys meet their groups by broadcast, which is less than HOT rows; the others are
    shuffled, and no key brings one task more than a part in HOT of all rows.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT > total
    some = F.broadcast(groups.where(hot))
    return rows.join(some, keys).unionByName(
        rows.join(some.select(*keys), keys, "left_anti").join(groups.where(~hot), keys)
    )


def held_out(column: str = "doc_id") -> F.Column:
    """True for the fifth of the documents whose labels are never learned."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """Up to `rows` labelled documents outside the held-out fold, picked by hash of the id."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = x + ONE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x2545F4914F6CDD1D)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("up", BASE), ("down", INVERSE)):
            _powers[name] = np.concatenate(
                [np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))]
            )
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z lower-cased, and the number of its text."""
    return word_spans(texts)[:2]


def word_spans(texts: list[bytes]):
    """Hash, text, first byte and end of every word, and the bytes as they were."""
    ends = np.cumsum([len(x) + 1 for x in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    raw = data
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    step = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    up, down = powers(len(data))
    sums = np.concatenate(
        [np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
    )
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(ends, start, side="right"), start, end, raw


def shingle_hashes(words: np.ndarray, owner: np.ndarray, k: int, texts: int):
    """Hashes of all k-word shingles in order, with their texts; a shorter text is one shingle."""
    n = len(words)
    total = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        total = total * BASE + words[j : n - k + 1 + j] if n >= k else total
    whole = owner[: n - k + 1] == owner[k - 1 :] if n >= k else np.zeros(0, bool)
    hashes, owners = mixed(total[whole]), owner[: len(whole)][whole]
    counts = np.bincount(owner, minlength=texts)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.cumsum(counts) - counts
        more = []
        for d in short:
            h = np.uint64(counts[d])
            for w in words[first[d] : first[d] + counts[d]]:
                h = mixed(np.array([h], np.uint64) * BASE + w)[0]
            more.append(h)
        hashes = np.concatenate([hashes, np.array(more, np.uint64)])
        owners = np.concatenate([owners, short])
    return hashes, owners


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty without words."""
    words, owner = word_hashes(texts)
    hashes, owners = shingle_hashes(words, owner, k, len(texts))
    order = np.argsort(owners, kind="stable")  # only short texts are out of place
    hashes, owners = hashes[order], owners[order]
    for some in np.split(hashes, np.searchsorted(owners, np.arange(1, len(texts)))):
        some.sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[keep], owners[keep]
    return np.split(hashes, np.searchsorted(owners, np.arange(1, len(texts))))


def chunks(batch: pa.RecordBatch, column: str = "text"):
    """(first row, texts as bytes) of slices of about a megabyte; a null is an empty text."""
    texts, size, first = [], 0, 0
    values = batch.column(column)
    for i in range(batch.num_rows):
        value = values[i].as_py()
        texts.append((value or "").encode("utf-8", "surrogatepass"))
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, texts
