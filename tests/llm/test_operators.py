"""Text operators against brute force, round trips and held-out labels."""

import hashlib
import re
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from idlewatch.llm import (
    decontamination, licences, mixing, neighbours, quality, queries, records, repeats, similar_sets, toxicity, wordpieces,
)
from idlewatch.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row int, key string"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from the old stone house by the river "
    texts = [None, "", " \n ", "one two", "One TWO", "a b c d e", base, base, base + "today", "x" * 500, "x" * 500,
             base * 30, base * 30 + "end", "Licensed under the Apache License, Version 2.0.", "ab " * 300, "é" * 250 + base * 3]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 4}", None, 0.5, 1, "k") for i, t in enumerate(texts)]
    rows += [rows[6], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


def plain_set(text, k=5):
    words = WORDS.findall((text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("which", ["odd", "none", "sf"])
def test_jaccard_join(spark, sf_dir, odd, none, which):
    docs = {"odd": odd, "none": none, "sf": table(spark, sf_dir, "documents")}[which]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in similar_sets.near_components(docs).collect())
    assert got == plain_components(rows)


def test_jaccard_join_light_and_heavy_sets(spark):
    """Chains of edits over every size near the boundary."""
    rng = np.random.default_rng(1)
    rows = []
    for n in range(3, 60):
        words = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        for _ in range(3):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[int(rng.integers(0, len(words)))] = "edit"
            words += ["tail"] * int(rng.integers(0, 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in similar_sets.near_components(docs).collect())
    assert got == plain_components(rows)


def test_jaccard_join_texts_without_or_with_clashing_ids(spark):
    """A text found only under null ids bridges two others; one id carries different texts."""
    words = [f"w{i}" for i in range(100)]
    bridge = " ".join(words)
    ends = " ".join(words[14:]), " ".join(words[:-14])
    other = [f"z{i}" for i in range(60)]
    rows = [(1, ends[0]), (2, ends[1]), (None, bridge), (7, " ".join(other)), (7, "q r s t u v w"), (8, " ".join(other[:-2])), (7, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in similar_sets.near_components(docs).collect())
    assert got == plain_components(rows)
    assert {r.doc_id: r.component_id for r in similar_sets.near_components(docs.where("doc_id IS NULL OR doc_id < 3")).collect()} == {1: 1, 2: 1, None: None}


def plain_links(texts):
    sets = [plain_set(t) for t in texts]
    return [sum(1 for j, y in enumerate(sets) if i != j and x & y and 100 * len(x & y) >= 75 * len(x | y)) for i, x in enumerate(sets)]


@pytest.mark.parametrize("members", [2048, 3])
def test_jaccard_join_counts_all_links(spark, monkeypatch, members):
    """Groups of near copies, chains and exact copies: links that touch no list head count too."""
    monkeypatch.setattr(similar_sets, "MEMBERS", members)
    rng = np.random.default_rng(2)
    texts = ["", None]
    for n in (8, 30, 90, 200):
        base = [f"v{x}" for x in rng.integers(0, 10**6, n)]
        texts += [" ".join([*base, f"tail{i}"]) for i in range(6)] + [" ".join(base)] * 4
        words = list(base)
        for _ in range(8):
            words = [*words[max(1, n // 12) :], *(f"v{x}" for x in rng.integers(0, 10**6, max(1, n // 12)))]
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in similar_sets.near_components(docs).collect()}
    assert [got[i] for i in range(len(texts))] == plain_links(texts)


def test_lists_of_one_set_are_dropped_by_hash(spark):
    """Most keys belong to one set: their entries are neither sorted nor merged before they go."""
    rows = [(1, 10, 5, True, 0), (1, 10, 5, True, 0), (2, 10, 5, False, 1), (2, 11, 6, False, 2), (2, 11, 6, False, 2), (3, 12, 6, False, 1), (1, 12, 6, False, 0)]
    entries = spark.createDataFrame(rows, "key long, sid long, n int, light boolean, rest int").repartition("key", "light")
    many = similar_sets.lists_of_many(entries)
    assert sorted(tuple(r) for r in many.select("key", "light", "sid").collect()) == [(2, False, 10), (2, False, 11)]
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    told = similar_sets.apart(entries, None, 1)
    assert "Join" not in told._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.sid, r.head.sid) for r in told.collect()} == {(10, 11), (11, 10)}


def test_set_numbers_of_a_chunk_depend_on_each_set_alone():
    sets = similar_sets.shingle_sets([b"", b"one two", b"a b c d e f g h " * 3, b" ", b"a b c d e f g h " * 2, b"x " * 40])
    alone = [similar_sets.identities([x])[0] for x in sets]
    assert similar_sets.identities(sets).tolist() == alone and alone[0] == alone[3] == 0 and alone[2] == alone[4] != 0
    assert [p.tolist() for p in similar_sets.parities(sets)] == [similar_sets.parities([x])[0].tolist() for x in sets]


def test_token_counts_match_greedy_pieces(spark, odd, none):
    import json

    path = records.vocabulary()
    with open(path, encoding="utf-8") as file:
        vocabulary = set(json.load(file)["model"]["vocab"])
    alphabet = wordpieces.byte_alphabet()

    def greedy(word):
        text, n = "".join(alphabet[b] for b in word.encode()), 0
        while text:
            size = next((k for k in range(len(text), 0, -1) if (text[:k] + "</w>" if k == len(text) else text[:k]) in vocabulary), None)
            # The longest match may stop before the mark, which then needs a token of its own.
            if size == len(text) or size is None:
                return n + 1 if size else 1
            text, n = text[size:], n + 1
        return n

    for r, got in zip(odd.collect(), wordpieces.token_counts(odd, path).collect(), strict=True):
        words = (r.text or "").lower().split()
        assert (got.n_words, got.n_tokens) == (len(words), sum(map(greedy, words)))
    assert wordpieces.token_counts(none, path).count() == 0


def test_automaton_unknown_and_backtracking():
    a = wordpieces.Automaton(["a", "abcd", "b", "c", "bc"])
    assert [a.count(w) for w in ("abcd", "abc", "abcx", "bca", "")] == [1, 2, 1, 2, 0]


def accuracy(scores, labels, label):
    rows = scores.where("held_out").join(labels, "doc_id").select("score", label).toPandas()
    pos, neg = rows[rows[label] == 1].score.to_numpy(), rows[rows[label] == 0].score.to_numpy()
    return (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    assert accuracy(toxicity.scored(docs, labels), labels, "toxic") > 0.9
    assert accuracy(quality.scored(docs, labels), labels, "quality") > 0.9


@pytest.mark.parametrize("scored", [toxicity.scored, quality.scored])
def test_classifiers_on_odd_rows(spark, odd, none, labels, scored):
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in range(16)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = scored(odd, marks).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert scored(none, marks).count() == 0
    assert all(0 <= r.score <= 1 for r in scored(odd, marks.limit(0)).collect())


def plain_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(np.frombuffer(d, np.uint8)[~gone])
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((len(d), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("which", ["odd", "none", "sf"])
def test_repeats(spark, sf_dir, odd, none, which):
    docs = {"odd": odd, "none": none, "sf": table(spark, sf_dir, "documents")}[which]
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(docs).collect())
    assert got == plain_removed([r.text for r in docs.select("text").collect()], 200)


def test_repeats_of_a_frequent_line(spark, monkeypatch):
    """A line in ever other surroundings, some of them repeated: no task may hold all of its runs."""
    monkeypatch.setattr(repeats, "HOT_KINDS", 4)
    rng = np.random.default_rng(4)
    part = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    line, after, before = part(70), part(180), part(150)
    texts = [part(200) + line + (after if i % 7 == 0 else part(180)) for i in range(24)]
    texts += [part(90) + before + line + after + part(60) for _ in range(3)] + [before + line + part(100)] * 2
    held, plain = [], repeats.repeated_windows

    def spied(rows):
        held.extend(r["count"] for r in rows.groupBy("key").count().collect())
        return plain(rows)

    monkeypatch.setattr(repeats, "repeated_windows", spied)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(docs).collect())
    assert got == plain_removed(texts, 200) and any(r[1] for r in got)
    assert max(held, default=0) <= 4


def test_windows_of_frequent_lines_are_filtered_not_multiplied(spark):
    """The windows meet the repeated ones in a semi join, which gives no row more than it takes."""
    rng = np.random.default_rng(5)
    blobs = [rng.integers(0, 9, 40, dtype=np.uint64).tobytes() for _ in range(6)]
    rows = spark.createDataFrame([(7, i, bytearray(b)) for i, b in enumerate(blobs)], "key long, run long, windows binary")
    found = repeats.repeated_hot_windows(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "Join Inner" not in plan
    spans = lambda df: sorted(tuple(r) for r in df.collect())
    assert spans(found) == spans(repeats.repeated_windows(rows)) and found.count() > 0


def test_neighbours_recall_and_scores(spark, sf_dir):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.select("vec_id", "embedding").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float)
    got = neighbours.search(df, df.where("vec_id % 100 = 0").select("vec_id"), window=500).toPandas()
    found = total = 0
    for q, part in got.groupby("query_id"):
        dist = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in ids[np.lexsort((ids, dist))] if i != q][:10]
        found, total = found + len(set(order) & set(part.vec_id)), total + 10
        assert sorted(part["rank"]) == list(range(1, 11))
    assert total == 10 * (ids % 100 == 0).sum() and found / total >= 0.9


def test_neighbours_exact_over_many_blocks(spark, monkeypatch):
    """Far more rows than a query meets in its windows, off centre, unevenly spread; several blocks of queries."""
    monkeypatch.setattr(neighbours, "QUERIES", 30)
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(4000, 24)) * np.linspace(0.2, 3, 24) + 5).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.search(df, df.where("vec_id % 50 = 0").select("vec_id"), orderings=2, window=20).collect()
    want = []
    for q in range(0, len(x), 50):
        dist = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), dist)) if i != q][:10]
        want += [(q, n + 1, int(i), float(dist[i])) for n, i in enumerate(order)]
    assert sorted(map(tuple, got)) == want


def test_neighbours_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (200, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 100 = 0").select("vec_id")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(df, asked).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 200, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 200, 1.0),
                   (200, 1, 0, 1.0), (200, 2, 1, 1.0), (200, 3, 100, 1.0)]
    assert neighbours.search(df.limit(0), asked.limit(0)).count() == 0


def test_decontamination(spark, sf_dir, odd, none):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    bags = []
    for r in items.collect():
        w = WORDS.findall(r.text.encode().translate(lower))
        bags.append((r.item_id, [tuple(w[i : i + 5]) for i in range(len(w) - 4)]))
    want = set()
    for r in docs.collect():
        w = WORDS.findall((r.text or "").encode().translate(lower))
        shingles = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for item, bag in bags:
            if not set(bag) & set(shingles):
                continue
            for s in range(max(1, len(shingles) - len(bag) + 1)):
                window = shingles[s : s + len(bag)]
                both = sum(min(window.count(x), bag.count(x)) for x in set(window))
                if both >= 0.75 * (len(window) + len(bag) - both):
                    want.add((r.doc_id, item))
                    break
    assert want and got == want
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.contaminated(odd, items.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id long, text string")
    assert {r.doc_id for r in decontamination.contaminated(odd, short).collect()} == {3, 4}


def test_decontamination_of_unlike_fingerprints(spark):
    """Six of seven shingles are shared (0.75), though the SimHashes differ in 26 bits."""
    words = [f"w{x}" for x in (244162, 151993, 359739, 72816, 554087, 595673, 586392, 366894, 127524, 980260, 81911, 397516)]
    items = spark.createDataFrame([(1, " ".join(words[:11]))], "item_id long, text string")
    docs = spark.createDataFrame([(5, " ".join(words[:10] + words[11:]))], "doc_id long, text string")
    assert [tuple(r) for r in decontamination.contaminated(docs, items).collect()] == [(5, 1, 0.75, 0, 11)]


def test_mixing_matches_sql_and_targets(spark, odd, none, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(mixing.ORACLE.format(docs="documents")).fetchall()
    docs = table(spark, sf_dir, "documents")
    got = mixing.mixed_copies(docs).selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    by = mixing.mixed_copies(docs).groupBy("source").agg({"target": "max"}).count()
    assert by == docs.select("source").distinct().count()
    assert mixing.mixed_copies(odd).count() == odd.count() and mixing.mixed_copies(none).count() == 0
    assert mixing.mixture(docs).count() == sum(r.copies for r in mixing.mixed_copies(docs).collect())
    assert mixing.mixture(odd).columns == odd.columns


def test_token_records_round_trip(spark, odd, none, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(records.vocabulary())
    for docs in (table(spark, sf_dir, "documents"), odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        at, want = 0, []
        for r in sorted(docs.select("doc_id", "text").collect()):
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
            want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert sorted(map(tuple, records.token_records(spark, docs, records.vocabulary()).collect())) == want
    assert records.token_records(spark, odd, records.vocabulary()).count() == odd.count()
    assert records.token_records(spark, none, records.vocabulary()).count() == 0


def test_records_by_index_in_any_order(spark, odd, tmp_path):
    manifest = records.write_records(odd, f"file:{tmp_path}/r", records.vocabulary(), 3).collect()
    encode = records.Encoder(records.vocabulary())
    rng, found = np.random.default_rng(3), []
    for r in manifest:
        order = rng.permutation(r.n_records).tolist()
        found += records.fetched(r.path, order)
        assert [k for k, _ in records.fetched(r.path, order[:1])] == [found[-r.n_records][0]]
    want = sorted((str(r.doc_id), encode(r.text or "") + b"\x02\x00") for r in odd.collect())
    assert sorted((str(k), ids.astype("<u2").tobytes()) for k, ids in found) == want


def test_encoder_equals_the_tokenizer(monkeypatch):
    """Also with a cache of three pieces and texts in slices of ten characters; ids of four bytes."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(records.vocabulary())
    texts = ["", " ", "  a  b ", "it's we'll\tdon't\r\nI'M", "e\u0301 \u0301x y\u00a0z\u2003q", "x" * 50 + " y" * 20, "\x0bv\x0c \x1f\x00 1234", "Ünï \U0001f600\U0001f600 ﬁ"]
    for cache, width in ((800_000, 2), (3, 2), (3, 4)):
        monkeypatch.setattr(records, "CACHE", cache)
        encode = records.Encoder(records.vocabulary())
        encode.width = width
        for text in texts + texts:
            want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, f"<u{width}").tobytes()
            assert encode(text) == want and b"".join(encode.encoded(s) for s in records.slices(text, 10)) == want, text
    assert records.file_system("file:///tmp/x")[1] == "/tmp/x"


def test_new_pieces_of_texts_are_encoded_together(monkeypatch):
    """One call of the tokenizer for a group of texts; letters with marks behind them share their word's ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(records.vocabulary())
    texts = [f"new{i} Wordy{'é' * i}, both\tw\n{i}" for i in range(50)]
    texts += ["abc abc. ABC!! Ünïß) éß´ it's it' a_b x<|endoftext|> x<| µm, Ö\u0301. ÀÿÞ;- e\u0301, a\x7f naïve's"]
    for cache in (800_000, 3):
        monkeypatch.setattr(records, "CACHE", cache)
        encode, calls = records.Encoder(records.vocabulary()), []
        plain = encode.encode
        monkeypatch.setattr(encode, "encode", lambda pieces: (calls.append(pieces), plain(pieces)))  # noqa: B023
        found = list(records.groups([pa.scalar(t, pa.string()) for t in [*texts, None]], 200))
        assert [t for some in found for t in some] == [*texts, ""] and 1 < len(found) < 20
        for some in found:
            want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in some]
            assert encode.many(some) == want
        assert len(calls) == len(found)
        assert not {"abc.", "ABC!!", "Ünïß)"} & {p for pieces in calls for p in pieces}


def test_damaged_records_are_refused():
    good = bytearray(records.frame(b"payload"))
    assert bytes(records.unframed(memoryview(good), 0)[0]) == b"payload"
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 1
        with pytest.raises((ValueError, Exception)):
            records.unframed(memoryview(bad), 0)


def test_licences(spark, odd, none):
    rows = [(1, "LICENCED under the Apache Licence version 2.0", "x"), (2, "intro\n© 2020 Someone\nReleased under the MIT License.\nmore", "x"),
            (3, None, "x"), (4, "", "x"), (5, "unrelated", "x"), (1, "unrelated", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licence string")
    got = sorted((r.doc_id, r.whole_text or "", r.licences) for r in licences.scan(docs, licences.registry(spark)).collect())
    assert got == [(1, "", ""), (1, "Apache-2.0", "Apache-2.0"), (2, "", "MIT"), (3, "", ""), (4, "", ""), (5, "", "")]
    assert licences.scan(odd, licences.registry(spark)).count() == odd.count()
    assert licences.scan(none, licences.registry(spark)).count() == 0


def test_licences_whole_texts(spark):
    """Documents that are a whole licence, with a copyright line of their own and other line ends."""
    mit = (licences.TEXTS / "MIT.txt").read_text(encoding="utf-8").replace("MIT License\n", "MIT License\n\nCopyright (c) 2024 Someone Else\n", 1)
    read = {n: (licences.TEXTS / f"{n}.txt").read_text(encoding="utf-8") for n in ("Apache-2.0", "GPL-3.0", "BSD-3-Clause", "0BSD")}
    rows = [(0, mit), *((i + 1, x.replace("\n", "\r\n  ").upper()) for i, x in enumerate(read.values()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.whole_text for r in licences.scan(docs, licences.registry(spark)).collect()}
    assert got == dict(enumerate(["MIT", *read]))


def test_licences_lines_of_a_given_registry(spark):
    """A notice without any word of the usual licences; an empty text in the registry matches nothing."""
    known = spark.createDataFrame([("Beerware", "Buy me a beer, (per cent) free!"), ("Void", " -- "), ("None", None)], "licence string, text string")
    docs = spark.createDataFrame([(1, "x\n\n  BUY me a beer: percent free\r\n--\nCopyright 2020 y"), (2, ""), (3, "buy me a beer")], "doc_id long, text string")
    assert {r.doc_id: (r.whole_text, r.licences) for r in licences.scan(docs, known).collect()} == {1: (None, "Beerware"), 2: (None, ""), 3: (None, "")}


def test_registry_names():
    assert [f"op{n}_" for n in range(1, 14)] == [re.match(r"op\d+_", k)[0] for k in queries.registry()]
