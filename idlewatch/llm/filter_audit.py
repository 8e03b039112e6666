"""Interaction of five text filters, from a sparse document-term matrix.

Words are maximal [^\\x20\\x09-\\x0D]+ of the whole text, case-sensitive, as bytes. A text fails

    A  with fewer than 50 words            B  if 100 * distinct words < 65 * words
    C  if 100 * [A-Z] > 5 * code points    D  if it holds any of #$%&*|
    E  if it is identical to the text of a smaller doc_id (equal SHA-256 of the whole text)

The matrix is built in CSR shards, one row of it per document. Each task numbers the distinct
words of about 32 MB of text, bucket by bucket of their hashes, and writes the shard in these
local numbers next to its words. The words are dealt by bucket; a task goes through the shards
in order and gives each word it meets first the next number of its bucket. Held at once are the
distinct words of one of BUCKETS buckets. Each shard's numbers come back and replace the local
ones. Row sums of a shard are the words of its documents, its nonzeros the distinct words: both
decide A and B. C, D and the digest for E come from the same reading.

Per part (source) at most 32 sets of failed filters times the labels are left, so the 120 orders are
evaluated on counts. A document is removed by the first filter of the order that it fails; over
all orders each of its k failed filters is first in 120 / k of them.

Null text: empty, fails A alone (and E after a smaller id with an empty text). Null source: part
''. A row without id has no smaller id and makes none, and no label. Repeated ids: each row
counts, none is the smaller one of the other; all have the id's labels (1 if any label row says
1). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import CHUNK, joined_by_size, stored

FILTERS = "ABCDE"
SHARD_BYTES = 1 << 25
BUCKETS = 4096
BLANKS = b" \t\n\x0b\f\r"
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"
#: Salts of rows without an id, which no label row meets.
SALTS = 1024

ROWS = "doc_ids array<bigint>, parts array<string>, digests array<binary>, flags array<int>"
LOCAL = f"shard bigint, {ROWS}, indptr binary, indices binary, data binary, words array<struct<bucket: int, list: binary>>"
NUMBERS = "shard bigint, bucket int, size int, ids binary"
GLOBAL = f"shard bigint, {ROWS}, indptr binary, indices binary, data binary"
FACTS = "doc_id bigint, part string, digest binary, flags int, words bigint, distinct_words bigint"


def pieces(data: bytes, size: int):
    """The text in slices of about so many bytes that end at blanks."""
    at = 0
    while len(data) - at > size:
        end = max(data.rfind(BLANKS[i : i + 1], at + 1, at + size) for i in range(len(BLANKS)))
        if end < 0:  # one word over the whole slice
            ends = [data.find(BLANKS[i : i + 1], at + 1) for i in range(len(BLANKS))]
            end = min((e for e in ends if e >= 0), default=len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the fewest bytes per value that hold them all."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if most < 1 << (8 * w)))


def widened(raw: bytes, values: int) -> np.ndarray:
    """What `narrow` wrote, from the number of values."""
    return np.frombuffer(raw, f"<u{len(raw) // values}") if values else np.zeros(0, np.uint8)


class Shard:
    """CSR rows of consecutive documents, in local word numbers."""

    def __init__(self, buckets: int, chunk: int) -> None:
        self.buckets, self.chunk = buckets, chunk
        self.numbers: defaultdict = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.rows: tuple[list, ...] = ([], [], [], [])
        self.indptr, self.indices, self.data, self.size = [0], [], [], 0

    def add(self, doc_id, source, text) -> None:
        text = text or ""
        raw = text.encode()
        counts: Counter = Counter()
        for piece in pieces(raw, self.chunk):
            counts.update(piece.split())
        failed_c = 100 * (len(raw) - len(raw.translate(None, UPPER))) > 5 * len(text)
        failed_d = len(raw.translate(None, MARKS)) < len(raw)
        values = (doc_id, source or "", hashlib.sha256(raw).digest(), 4 * failed_c + 8 * failed_d)
        for column, value in zip(self.rows, values, strict=True):
            column.append(value)
        self.indices.append(np.fromiter(map(self.numbers.__getitem__, counts), np.uint32, len(counts)))
        self.data.append(np.fromiter(counts.values(), np.uint32, len(counts)))
        self.indptr.append(self.indptr[-1] + len(counts))
        self.size += len(raw) + 64

    def bucketed(self) -> tuple[np.ndarray, list]:
        """New local numbers, by bucket; and the words of each bucket that has any, in that order."""
        words = list(self.numbers)
        buckets = np.fromiter((crc32(w) % self.buckets for w in words), np.int64, len(words))
        order = np.argsort(buckets, kind="stable")
        numbers = np.empty(len(words), np.uint32)
        numbers[order] = np.arange(len(words), dtype=np.uint32)
        cuts = np.searchsorted(buckets[order], np.arange(self.buckets + 1)).tolist()
        order = order.tolist()
        lists = [
            {"bucket": i, "list": b" ".join([words[w] for w in order[low:high]])}
            for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)) if low < high
        ]
        return numbers, lists

    def batch(self, shard: int) -> pa.RecordBatch:
        numbers, lists = self.bucketed()
        indices, data = numbers[np.concatenate(self.indices)], narrow(np.concatenate(self.data))
        parts = [np.array(self.indptr, np.int64), indices, data]
        columns = [[shard], *([c] for c in self.rows), *([p.tobytes()] for p in parts), [lists]]
        types = (pa.int64(), pa.string(), pa.binary(), pa.int32())
        pair = pa.struct([("bucket", pa.int32()), ("list", pa.binary())])
        kinds = [pa.int64(), *map(pa.list_, types), *[pa.binary()] * 3, pa.list_(pair)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["shard", "doc_ids", "parts", "digests", "flags", "indptr", "indices", "data", "words"],
        )


def local_shards(docs: DataFrame) -> DataFrame:
    limits = BUCKETS, CHUNK

    def run(batches):
        made, shard = 0, Shard(*limits)
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                shard.add(*(v.as_py() for v in row))
                if shard.size >= SHARD_BYTES:
                    yield shard.batch(first + made)
                    made, shard = made + 1, Shard(*limits)
        if shard.rows[0]:
            yield shard.batch(first + made)

    used = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    return used.mapInArrow(run, LOCAL)


def by_bucket(local: DataFrame) -> DataFrame:
    """(shard, bucket, list), each bucket in one task in the order of shards."""
    words = local.select("shard", F.explode("words").alias("x")).select("shard", "x.bucket", "x.list")
    return words.repartition("bucket").sortWithinPartitions("bucket", "shard")


def global_numbers(local: DataFrame) -> DataFrame:
    """(shard, bucket, ids): the numbers of the bucket's words. Place in the bucket times BUCKETS, plus bucket."""
    def run(batches):
        now, seen = None, {}
        for batch in batches:
            out, sizes = [], []
            for bucket, words in zip(batch["bucket"].to_pylist(), batch["list"], strict=True):
                if bucket != now:
                    now, seen = bucket, defaultdict()
                    seen.default_factory = seen.__len__
                words = words.as_py().split(b" ")
                places = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
                out.append(narrow(places * BUCKETS + bucket).tobytes())
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch["shard"], batch["bucket"], pa.array(sizes, pa.int32()), pa.array(out, pa.binary())],
                names=["shard", "bucket", "size", "ids"],
            )

    return by_bucket(local).mapInArrow(run, NUMBERS)


def dictionary(local: DataFrame, numbers: DataFrame) -> DataFrame:
    """(word, id) of all words."""
    def run(batches):
        for batch in batches:
            for words, size, ids in zip(batch["list"], batch["size"], batch["ids"], strict=True):
                values = widened(ids.as_py(), size.as_py()).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.as_py().split(b" "), pa.binary()), pa.array(values)], names=["word", "id"])

    both = by_bucket(local).join(numbers, ["shard", "bucket"])
    return both.select("list", "size", "ids").mapInArrow(run, "word binary, id bigint").distinct()


def term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(CSR shards in global word numbers, dictionary), from tables written to the shared folder.

    A shard is one row: facts of its documents as arrays, `indptr` (int64), `indices` and `data`
    (unsigned, `widened` reads them), little-endian. The dictionary has (word, id).
    """
    local = stored(local_shards(docs), "local-shards", "zstd")
    numbers = stored(global_numbers(local), "word-numbers", "zstd")
    lists = numbers.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("bucket", "size", "ids"))).alias("lists"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                indices = np.frombuffer(one["indices"][0].as_py(), np.uint32)
                lists = one["lists"][0].as_py()
                # A shard of texts without any word has no words to be numbered.
                if lists:
                    indices = np.concatenate([widened(x["ids"], x["size"]).astype(np.uint64) for x in lists])[indices]
                columns = [one[c] for c in ("shard", "doc_ids", "parts", "digests", "flags", "indptr")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([narrow(indices).tobytes()], pa.binary()), one["data"]],
                    names=["shard", "doc_ids", "parts", "digests", "flags", "indptr", "indices", "data"],
                )

    both = local.drop("words").join(lists, "shard", "left")
    return stored(both.mapInArrow(run, GLOBAL), "shards", "zstd"), dictionary(local, numbers)


def row_facts(shards: DataFrame) -> DataFrame:
    """One row per document: row sum and nonzeros of its matrix row, with its other facts."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ends = np.frombuffer(one["indptr"][0].as_py(), np.int64)
                data = widened(one["data"][0].as_py(), int(ends[-1]))
                sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(data, dtype=np.int64)])[ends]
                yield pa.RecordBatch.from_arrays(
                    [*(one[c].flatten() for c in ("doc_ids", "parts", "digests", "flags")), pa.array(np.diff(sums)), pa.array(np.diff(ends))],
                    names=["doc_id", "part", "digest", "flags", "words", "distinct_words"],
                )

    return shards.drop("shard", "indices").mapInArrow(run, FACTS)


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """good and toxic (0 or 1) by doc_id; rows without an id are spread over salts that no label has."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("CAST(quality <=> 1 AS INT)")).alias("good"), F.max(F.expr("CAST(toxic <=> 1 AS INT)")).alias("toxic")
    ).withColumn("salt", F.lit(0))
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.hash("digest", "part"), F.lit(SALTS))).otherwise(F.lit(0))
    return rows.withColumn("salt", salt).join(marks, ["doc_id", "salt"], "left").drop("salt").fillna(0, ["good", "toxic"])


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, words, distinct_words and failed: bits 1, 2, 4, 8, 16 for A to E."""
    shards, _ = term_matrix(docs)
    rows = stored(row_facts(shards), "row-facts")
    least = rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    found = joined_by_size(rows, stored(least, "least-ids"), ["digest"], "copies")
    failed = """CAST(words < 50 AS INT) + 2 * CAST(100 * distinct_words < 65 * words AS INT) + flags
        + 16 * CAST(coalesce(doc_id > least, false) AS INT)"""
    return found.select("doc_id", "part", "digest", "words", "distinct_words", F.expr(failed).cast("int").alias("failed"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    cells = with_labels(failures(docs), labels).groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.sum("good").alias("n_good"), F.sum("toxic").alias("n_toxic")
    )
    orders = ["".join(p) for p in permutations(FILTERS)]
    rows = (
        cells.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.array(*[F.lit(i + 1) for i in range(len(FILTERS))])))
        .withColumn("bit", F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)"))
        .withColumn("first", F.expr("coalesce(array_min(transform(filter(sequence(1, 5), s -> "
                                    f"failed & shiftleft(1, instr('{FILTERS}', substring(filter_order, s, 1)) - 1) != 0), s -> s)), 6)"))
    )
    counted = {
        "kept": "CASE WHEN first > step THEN n ELSE 0 END",
        "removed": "CASE WHEN first = step THEN n ELSE 0 END",
        "redundant": "CASE WHEN first < step AND failed & bit != 0 THEN n ELSE 0 END",
        "unique_fails": "CASE WHEN failed = bit THEN n ELSE 0 END",
        "good_lost": "CASE WHEN first = step THEN n_good ELSE 0 END",
        "toxic_lost": "CASE WHEN first = step THEN n_toxic ELSE 0 END",
        "shapley": "CASE WHEN failed & bit != 0 THEN n * (120 div bit_count(failed)) ELSE 0 END",
    }
    return rows.groupBy("part", "filter_order", "step").agg(*[F.sum(F.expr(e)).cast("long").alias(c) for c, e in counted.items()])


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') AS split FROM t),
v AS (SELECT *, CASE WHEN split = [''] THEN [] ELSE split END AS words FROM w),
f AS (SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS failed FROM v),
m AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
    FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places
    FROM l a JOIN l b ON b.i <> a.i JOIN l c ON c.i NOT IN (a.i, b.i)
    JOIN l d ON d.i NOT IN (a.i, b.i, c.i) JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
r AS (SELECT c.*, filter_order, places, coalesce(list_position([failed[p] FOR p IN places], true), 6) AS first FROM c CROSS JOIN o),
s AS (SELECT r.*, u.step, failed[places[u.step]] AS fails, len([x FOR x IN failed IF x]) AS k
    FROM r CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step) u),
h AS (SELECT part, places[step] AS letter, sum(n) FILTER (WHERE first = step) AS shapley FROM s GROUP BY ALL)
SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (WHERE first > step), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE first = step), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE fails AND first < step), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fails AND k = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE first = step), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (WHERE first = step), 0)::BIGINT AS toxic_lost,
    coalesce(max(h.shapley), 0)::BIGINT AS shapley
FROM s JOIN h USING (part) WHERE h.letter = places[step] GROUP BY part, filter_order, step
"""
