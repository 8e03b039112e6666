"""Token ids in length-delimited binary records, with a separate offset index.

Record: length (u64), masked CRC-32 of the length (u32), payload, masked CRC-32 of the payload
(u32), all little-endian. The payload is a flag byte (doc_id is there), the bytes per id (2 where
the vocabulary allows, else 4), the doc_id (i64) and the ids. `part-*.rec` holds records in ascending doc_id order, `part-*.idx` the
u64 offset of every record, so a reader can fetch them in any order. Files go to the shared
folder through Arrow's file systems under a name of the attempt; only files named by the
finished attempts (the manifest, a table) are read, so lost executors leave no doubt.

Null and empty texts give only the end id. Null ids come first. Repeated rows are records
of their own. An empty table gives an empty manifest. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import CHUNK, run_folder

END = 2
#: Pieces of a generation of the cache; a worker holds two at most.
CACHE = 800_000
HEAD = "<?Bq"
#: Under these rules of a tokenizer, letters and the marks behind them are encoded apart, letters as small ones.
FOLDS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS_APART = {
    "type": "Split", "behavior": "Removed", "invert": True,
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
}
#: Letters of ASCII and Latin-1, then ASCII marks but no apostrophe, which begins an ending.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
MANIFEST = "part int, path string, n_records long, n_tokens long"
READ = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
_loaded: dict = {}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), payload,
                     struct.pack("<I", masked(zlib.crc32(payload)))))


def unframed(data: memoryview, at: int) -> tuple[memoryview, int]:
    head = data[at : at + 8]
    (n,), (check,) = struct.unpack("<Q", head), struct.unpack("<I", data[at + 8 : at + 12])
    if masked(zlib.crc32(head)) != check:
        raise ValueError(f"damaged length at {at}")
    payload = data[at + 12 : at + 12 + n]
    if masked(zlib.crc32(payload)) != struct.unpack("<I", data[at + 12 + n : at + 16 + n])[0]:
        raise ValueError(f"damaged record at {at}")
    return payload, at + 16 + n


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path as Spark names it; it has one name for S3 only."""
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def slices(text: str, size: int = CHUNK):
    """The text in slices of about so many characters that end at ASCII spaces."""
    at = 0
    while len(text) - at > size:
        end = text.rfind(" ", at + 1, at + size)
        end = text.find(" ", at + 1) if end < 0 else end
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end
    yield text[at:]


def spaced(text: str) -> str:
    for blank in "\t\n\r":
        text = text.replace(blank, " ")
    return text


def groups(values: Iterable[pa.StringScalar], size: int = CHUNK):
    """The texts of an Arrow column, by neighbours of about so many characters; a null is an empty text."""
    texts, held = [], 0
    for value in values:
        texts.append(value.as_py() or "")
        held += len(texts[-1])
        if held >= size:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


class Encoder:
    """Ids of a text, by pieces between ASCII spaces: the tokenizer never joins across them.

    Pieces met before are looked up. The cache has two generations: a full young one becomes the
    old one, and pieces found there move to the young, so frequent pieces are never lost.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        rules = json.loads(self.tokenizer.to_str())
        known = (rules["normalizer"] or {}).get("normalizers") == FOLDS and (rules["pre_tokenizer"] or {}).get("pretokenizers", [None])[0] == WORDS_APART
        self.plain = PLAIN.fullmatch if known else lambda piece: None

    def encode(self, pieces: list[str]) -> None:
        for first in range(0, len(pieces), 20_000):
            some = pieces[first : first + 20_000]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            raw = np.array(found.ids, f"<u{self.width}").tobytes()
            owner = np.array(found.word_ids, np.int64)
            cuts = (np.searchsorted(owner, np.arange(len(some) + 1)) * self.width).tolist()
            self.young.update((p, raw[a:b]) for p, a, b in zip(some, cuts, cuts[1:], strict=False))

    def missing(self, pieces: Iterable[str]) -> list[str]:
        """Those in neither generation. Those of the old one move to the young."""
        new = [p for p in pieces if p not in self.young]
        self.young.update((p, self.old[p]) for p in new if p in self.old)
        return [p for p in new if p not in self.old]

    def learn(self, pieces: Iterable[str]) -> None:
        """Have all these pieces in the young generation; plain words by their small letters and marks."""
        new = self.missing(pieces)
        split = [(m[1].lower(), m[2]) if (m := self.plain(p)) else (p, "") for p in new]
        self.encode(self.missing({part for both in split for part in both}))
        self.young.update((p, self.young[word] + self.young[marks]) for p, (word, marks) in zip(new, split, strict=True))

    def together(self, parts: list[str]) -> list[bytes]:
        """Ids of several short texts. Each distinct piece is looked up once, all new ones are learned at once."""
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {"": b""}
        split = pc.split_pattern(pa.array([spaced(part) for part in parts], pa.large_string()), " ")
        numbered = split.flatten().dictionary_encode()
        pieces = numbered.dictionary.to_pylist()
        found = list(map(self.young.get, pieces))
        self.learn([p for p, ids in zip(pieces, found, strict=True) if ids is None])
        found = [self.young[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
        joined = pa.array(found, pa.large_binary()).take(numbered.indices)
        _, ends, ids = joined.buffers()
        ids = ids.to_pybytes() if ids else b""
        cuts = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encoded(self, text: str) -> bytes:
        return self.together([text])[0]

    def __call__(self, text: str) -> bytes:
        return b"".join([self.encoded(part) for part in slices(text)])

    def many(self, texts: list[str]) -> list[bytes]:
        return self.together(texts) if max(map(len, texts), default=0) <= CHUNK else [self(text) for text in texts]


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def write_records(docs: DataFrame, folder: str, tokenizer: str, shards: int) -> DataFrame:
    """Write the shards; returns the manifest, stored beside them."""
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        encode, at, n, tokens = encoder(tokenizer), 0, 0, 0
        out = index = None
        for batch in batches:
            keys = iter(batch["doc_id"])
            for texts in groups(batch["text"]):
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}.rec")
                    index = fs.open_output_stream(f"{root}/{name}.idx")
                for ids, doc_id in zip(encode.many(texts), keys):  # noqa: B905
                    key = doc_id.as_py()
                    ids += END.to_bytes(encode.width, "little")
                    record = frame(struct.pack(HEAD, key is not None, encode.width, key or 0) + ids)
                    out.write(record)
                    index.write(struct.pack("<Q", at))
                    at, n, tokens = at + len(record), n + 1, tokens + len(ids) // encode.width
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": f"{folder}/{name}", "n_records": n, "n_tokens": tokens}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64())]),
            )

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def content(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a record."""
    there, width, key = struct.unpack(HEAD, payload[: struct.calcsize(HEAD)])
    return key if there else None, np.frombuffer(payload[struct.calcsize(HEAD) :], f"<u{width}")


def fetched(path: str, places: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """doc_id and ids of the records at these places of a file's index, in the order asked for."""
    fs, root = file_system(path)
    offsets = np.frombuffer(fs.open_input_stream(f"{root}.idx").read(), "<u8")
    out = []
    with fs.open_input_file(f"{root}.rec") as source:
        for place in places:
            at = int(offsets[place])
            end = int(offsets[place + 1]) if place + 1 < len(offsets) else source.size()
            out.append(content(unframed(memoryview(source.read_at(end - at, at)), 0)[0]))
    return out


def read_records(manifest: DataFrame) -> DataFrame:
    """Per record, from the files: part, doc_id, at (ids before it in the part), n_tokens, ids_crc32."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = file_system(row["path"])
                rows, before, total = [], 0, 0
                offsets = np.frombuffer(fs.open_input_stream(f"{path}.idx").read(), "<u8")
                with fs.open_input_stream(f"{path}.rec") as source:
                    for at in offsets.tolist():
                        head = source.read(12)
                        size = struct.unpack("<Q", head[:8])[0]
                        payload, used = unframed(memoryview(head + source.read(size + 4)), 0)
                        if at != total:
                            raise ValueError(f"index and records differ at {at}")
                        total += used
                        key, ids = content(payload)
                        rows.append({"part": row["part"], "doc_id": key, "at": before,
                                     "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                        before += len(ids)
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    SCHEMA = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    spark = manifest.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks, "part").mapInArrow(read, READ)


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write, read back, and place each document in the whole: doc_id, start, n_tokens, ids_crc32.

    The prefix sum runs over one row per shard; within a shard the reader has counted.
    """
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = write_records(docs, run_folder(spark, "records"), tokenizer, shards)
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = manifest.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return read_records(manifest).join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
