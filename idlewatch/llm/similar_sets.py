"""N-gram Jaccard join: size-aware, light sets by enumerated subsets, heavy by inverted lists.

A text's set holds the 64-bit hashes of its distinct five-word shingles. Equal sets are one set
(its hash and size). Two sets that reach the threshold share at least t = ceil(threshold * n)
elements, so in any common order the first n - t + s elements of both share s.

* Light sets (at most `boundary` shingles): all subsets of two of the first n - t + 2 elements
  are keys. Equal keys are candidates.
* Heavy sets: the first n - t + 1 elements are the keys, whose inverted lists are scanned. Light
  sets near the boundary are listed too, since their partners may be heavy.
* The boundary is the size at which subsets begin to cost more than the lists (a table of
  costs by size). It changes the cost, never the result.

The order puts rare elements first: frequencies are counted for half of the hash space over all
texts, and kept as logarithms in a table of 2^22 bytes, the only thing broadcast.

Links are wanted for components, so a list of m sets is not turned into m^2 pairs. In a few rounds
each set is compared with one set: of the heads of its lists, always of another component, the one
it meets most often. Verified pairs form components, refused ones are remembered, and lists within
one component drop out. What is left is completed exactly: sets of one list in different components
are compared, unless one of these rules a link out:

* their sizes, or the parities of their elements on 256 bits;
* their places: up to its first common key a pair shares nothing, so what follows the key in the
  shorter rest bounds the overlap;
* an earlier key they share: the pair is already made there.

Rounds change the cost, never the result. No link between components is lost.

The links themselves are counted afterwards: all links lie within components, so all distinct sets
of a component are compared with each other, in blocks of bounded size dealt by component and pair
of blocks. No pair becomes a row; a task yields one sum for each set of its blocks.

Null and empty texts: empty set, linked with nothing. Rows without an id link by text but have a
null id themselves. Repeated rows are copies. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import BASE, chunks, mixed, shingle_sets, stored

CELLS = 22
LIGHT = 64
#: Shingles and sets of a block, on average.
ELEMENTS, MEMBERS = 1 << 19, 2048
#: Rounds with one partner a set, earlier keys a list's row carries, sets a task remembers.
ROUNDS, EARLIER, SEEN = 4, 16, 200_000
PARITY = ("p0", "p1", "p2", "p3")
SETS = "doc_id long, tkey long, n long, sid long, p0 long, p1 long, p2 long, p3 long"


def overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def sizes_and_ends(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in sets], np.int64)
    return sizes, np.cumsum(sizes)


def identities(sets: list[np.ndarray]) -> np.ndarray:
    """A number for each set that depends on its elements only; 0 for an empty set."""
    sizes, ends = sizes_and_ends(sets)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(np.concatenate(sets)))])
    total = (sums[ends] - sums[ends - sizes]) * BASE + sizes.astype(np.uint64)
    return np.where(sizes > 0, total, np.uint64(0)).view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """256 bits a set: whether an odd number of its elements falls on the bit."""
    owner = np.repeat(np.arange(len(sets)), sizes_and_ends(sets)[0])
    bit = (mixed(np.concatenate(sets)) & np.uint64(255)).astype(np.int64)
    odd = np.bincount(owner * 256 + bit, minlength=256 * len(sets)) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, 256), axis=1).view(np.int64)


def may_link(percent: int) -> F.Column:
    """False only for pairs (n_a, n_b and parities) that cannot reach the threshold.

    The sizes must fit, and each bit that differs stands for an element only one set has.
    """
    differing = " + ".join(f"bit_count({p}_a ^ {p}_b)" for p in PARITY)
    shared = f"(({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent})"
    return F.expr(
        f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {percent} AND {differing} <= n_a + n_b - 2 * {shared}"
    )


def may_start(percent: int) -> F.Column:
    """False only where a key is not the first that a linked pair shares, by sizes and what follows it."""
    shared = f"(({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent})"
    return F.expr(
        f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {percent} AND if(light, 2, 1) + least(rest_a, rest_b) >= {shared}"
    )


def with_sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for first, texts in chunks(batch):
                sets = shingle_sets(texts, k)
                bits = parities(sets)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.slice(first, len(texts))[c] for c in ("doc_id", "tkey")), pa.array([len(x) for x in sets], pa.int64()), pa.array(identities(sets)),
                     *(pa.array(bits[:, i]) for i in range(len(PARITY)))],
                    names=["doc_id", "tkey", "n", "sid", *PARITY])

    return docs.mapInArrow(run, SETS)


def counted(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64(1)) == 0


def frequency_levels(docs: DataFrame, k: int, n_docs: int) -> np.ndarray:
    """Per cell of the hash space, log2 of the largest frequency of its counted elements."""
    bits = min(CELLS - 2, max(8, math.ceil(math.log2(max(1, n_docs) / 500))))
    low = np.uint64(64 - bits)

    def local(batches):
        held, size = [], 0

        def packed():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(values >> low, np.arange(1, 1 << bits, dtype=np.uint64))
            parts = zip(np.split((values >> np.uint64(64 - bits - 32)).astype("<u4"), cut), np.split(np.minimum(counts, 255).astype("u1"), cut), strict=True)
            rows = [(i, v.tobytes(), c.tobytes()) for i, (v, c) in enumerate(parts) if len(v)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "hashes", "counts"])

        for batch in batches:
            for _, texts in chunks(batch):
                for x in shingle_sets(texts, k):
                    x = x[counted(x)]
                    held.append(x)
                    size += len(x)
                if size > 2_000_000:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    width = 1 << (CELLS - bits)

    def levels(df):
        import pandas as pd

        values = np.frombuffer(b"".join(df["hashes"]), "<u4")
        weights = np.frombuffer(b"".join(df["counts"]), "u1")
        values, back = np.unique(values, return_inverse=True)
        counts = np.bincount(back, weights=weights)
        table = np.zeros(width, np.uint8)
        np.maximum.at(table, values >> np.uint32(32 - (CELLS - bits)), np.floor(np.log2(counts)).astype(np.uint8))
        return pd.DataFrame({"part": [int(df["part"].iloc[0])], "levels": [table.tobytes()]})

    rows = docs.select("text").mapInArrow(local, "part int, hashes binary, counts binary")
    table = np.zeros((1 << bits, width), np.uint8)
    for r in rows.groupBy("part").applyInPandas(levels, "part int, levels binary").collect():  # 2^22 bytes in all
        table[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    return table.reshape(-1)


def in_order(x: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of a sorted set and their levels, rare ones first, equal levels as they were."""
    level = np.where(counted(x), table[(x >> np.uint64(64 - CELLS)).astype(np.int64)], np.uint8(60))
    order = np.argsort(level, kind="stable")
    return x[order], level[order]


def boundary_of(docs: DataFrame, table, k: int, percent: int) -> int:
    """The size up to which subsets cost less than inverted lists, summed over all sets."""
    def costs(batches):
        total = np.zeros((LIGHT + 1, 2))
        for batch in batches:
            for _, texts in chunks(batch):
                for x in shingle_sets(texts, k):
                    n = len(x)
                    if 1 < n <= LIGHT:
                        p = n - overlap(n, percent) + 1
                        level = in_order(x, table.value)[1][:p]
                        total[n] += (p + 1) * p / 2, (2.0 ** np.minimum(level, 10)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LIGHT + 1)), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["n", "subsets", "lists"])

    rows = docs.select("text").mapInArrow(costs, "n long, subsets double, lists double").groupBy("n").agg(F.sum("subsets").alias("s"), F.sum("lists").alias("l")).orderBy("n").collect()
    gain, best, at = 0.0, 0.0, 1
    for r in rows:
        gain += r["l"] - r["s"]
        if gain > best:
            best, at = gain, r["n"]
    return at


def keys(docs: DataFrame, table, boundary: int, k: int, percent: int) -> DataFrame:
    """(key, sid, n, light, rest) of every set; `rest` counts its elements after the key."""
    def run(batches):
        seen = set()
        for batch in batches:
            for _, texts in chunks(batch):
                out = []
                sets = shingle_sets(texts, k)
                for x, sid in zip(sets, identities(sets).tolist(), strict=True):
                    n = len(x)
                    if n < 2 or sid in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sid)
                    t = overlap(n, percent)
                    x = in_order(x, table.value)[0]
                    if n <= boundary:
                        i, j = np.triu_indices(min(n, n - t + 2), 1)
                        out.append((mixed(x[i] * BASE + x[j]), n - 1 - j, sid, n, True))
                    if n > boundary or n * 100 >= (boundary + 1) * percent:
                        out.append((x[: n - t + 1], n - 1 - np.arange(n - t + 1), sid, n, False))
                if out:
                    lens = [len(o[0]) for o in out]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([o[0] for o in out]).view(np.int64)), pa.array(np.repeat([o[2] for o in out], lens)),
                         pa.array(np.repeat([o[3] for o in out], lens).astype(np.int32)), pa.array(np.repeat([o[4] for o in out], lens)),
                         pa.array(np.concatenate([o[1] for o in out]).astype(np.int32))],
                        names=["key", "sid", "n", "light", "rest"])

    return docs.select("text").mapInArrow(run, "key long, sid long, n int, light boolean, rest int")


def texts_of(wanted: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(sid, text) of the wanted set ids: the text is found by its own hash, with or without a doc_id."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "tkey")).alias("x")
    readers = sets.join(wanted, "sid", "left_semi").groupBy("sid").agg(first).select("sid", F.col("x.tkey").alias("_tkey"), F.col("x.doc_id").alias("_doc_id"))
    rows = docs.select("doc_id", "tkey", "text")
    return rows.join(readers, (F.col("tkey") == F.col("_tkey")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))).dropDuplicates(["sid"]).select("sid", "text")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that reach the threshold, by their whole texts."""
    wanted = pairs.selectExpr("a AS sid").unionByName(pairs.selectExpr("b AS sid")).distinct()
    texts = stored(texts_of(wanted, sets, docs), "pair-texts")
    both = pairs.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("text")), "a").join(texts.select(F.col("sid").alias("b"), F.col("text").alias("other")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for (_, left), (_, right) in zip(aligned(batch, "text"), aligned(batch, "other"), strict=True):
                for x, y in zip(shingle_sets(left, k), shingle_sets(right, k), strict=True):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.select("a", "b", "text", "other").mapInArrow(run, "a long, b long"), "links")


def aligned(batch, column: str, rows: int = 64):
    for first in range(0, batch.num_rows, rows):
        yield first, [(x.as_py() or "").encode() for x in batch[column].slice(first, rows)]


def components(links: DataFrame) -> DataFrame:
    """(sid, comp): the smallest id that links reach, by label passing and pointer jumping."""
    edges = stored(links.selectExpr("a AS u", "b AS v").unionByName(links.selectExpr("b AS u", "a AS v")).distinct(), "edges")
    labels = stored(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("comp")), "labels")
    while True:
        heard = edges.join(labels.selectExpr("u AS v", "comp"), "v").groupBy("u").agg(F.min("comp").alias("heard"))
        low = labels.join(heard, "u").select("u", F.least("comp", "heard").alias("low"), F.col("comp").alias("was"))
        jump = low.join(labels.selectExpr("u AS low", "comp AS far"), "low", "left")
        new = stored(jump.select("u", F.least("low", F.coalesce("far", "low")).alias("comp"), "was"), "labels")
        done = new.where("comp != was").isEmpty()
        labels = new.select("u", "comp")
        if done:
            return labels.select(F.col("u").alias("sid"), "comp")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right."""
    many_l, many_r = len(left), len(right)
    values, number = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner_l, owner_r = (np.repeat(np.arange(len(x)), [len(e) for e in x]) for x in (left, right))
    number_l, number_r = number[: len(owner_l)], number[len(owner_l) :]
    count_l, count_r = (np.bincount(x, minlength=len(values)) for x in (number_l, number_r))
    cost = count_l * count_r
    out = np.zeros((many_l, many_r), np.int64)
    # Frequent elements by matrix products, the others by their pairs.
    dense = np.flatnonzero((cost > 1) & (cost * 32 >= many_l * many_r))
    column = np.full(len(values), -1)
    for first in range(0, len(dense), 1024):
        some = dense[first : first + 1024]
        column[some] = np.arange(len(some))
        a, b = np.zeros((many_l, len(some)), np.float32), np.zeros((many_r, len(some)), np.float32)
        for matrix, owners, numbers in ((a, owner_l, number_l), (b, owner_r, number_r)):
            at = column[numbers]
            matrix[owners[at >= 0], at[at >= 0]] = 1
        out += (a @ b.T).astype(np.int64)
        column[some] = -1
    cost[dense] = 0
    order = np.argsort(number_r, kind="stable")
    start = np.cumsum(count_r) - count_r
    keep = np.flatnonzero(cost[number_l] > 0)
    each = count_r[number_l[keep]]
    ends = np.cumsum(each)
    cuts = np.searchsorted(ends, np.arange(1 << 22, int(ends[-1]) + (1 << 22), 1 << 22) if len(ends) else [])
    for part in np.split(np.arange(len(keep)), cuts):
        if len(part):
            n = each[part]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            right_owner = owner_r[order[np.repeat(start[number_l[keep[part]]], n) + within]]
            out += np.bincount(np.repeat(owner_l[keep[part]], n) * many_r + right_owner, minlength=many_l * many_r).reshape(many_l, many_r)
    return out


def partners(comps: DataFrame, classes: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(sid, partners): the rows of all other sets that reach the threshold with the set."""
    blocks = F.greatest(F.ceil(F.sum("n") / ELEMENTS), F.ceil(F.count("*") / MEMBERS))
    members = comps.join(classes, "sid")
    members = members.join(members.groupBy("comp").agg(blocks.alias("blocks")), "comp").join(texts_of(comps.select("sid"), sets, docs), "sid")

    def elements(batches):
        for batch in batches:
            for first, texts in chunks(batch):
                some = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(some[c] for c in ("sid", "comp", "copies", "blocks")), pa.array([x.tobytes() for x in shingle_sets(texts, k)], pa.binary())],
                    names=["sid", "comp", "copies", "blocks", "elements"])

    def compared(rows):
        low, high = rows[0][1], rows[0][2]
        sides = [[r for r in rows if r[3] == b] for b in dict.fromkeys((low, high))]
        if not all(sides):
            return
        left, right = sides[0], sides[-1]
        x, y = ([np.frombuffer(r[6], np.uint64) for r in side] for side in (left, right))
        same = shared(x, y)
        link = 100 * same >= percent * (np.array([len(e) for e in x])[:, None] + np.array([len(e) for e in y]) - same)
        if low == high:
            np.fill_diagonal(link, False)
        told = [(left, link @ np.array([r[5] for r in right]))]
        if low != high:
            told.append((right, link.T @ np.array([r[5] for r in left])))
        for side, sums in told:
            yield pa.RecordBatch.from_arrays([pa.array([r[4] for r in side], pa.int64()), pa.array(sums.astype(np.int64))], names=["sid", "partners"])

    def run(batches):
        rows = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("comp", "low", "high", "block", "sid", "copies", "elements")), strict=True):
                if rows and rows[-1][:3] != row[:3]:
                    yield from compared(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from compared(rows)

    rows = members.select("sid", "comp", "copies", "blocks", "text").mapInArrow(elements, "sid long, comp long, copies long, blocks long, elements binary")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("sid"), "blocks")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    rows = rows.repartition("comp", "low", "high").sortWithinPartitions("comp", "low", "high")
    found = rows.select("comp", "low", "high", "block", "sid", "copies", "elements").mapInArrow(run, "sid long, partners long")
    return found.groupBy("sid").agg(F.sum("partners").alias("partners"))


def lists_of_many(entries: DataFrame) -> DataFrame:
    """The distinct entries of lists with more than one set; most keys belong to one set.

    They are told by two numbers a list, kept in hashes, so that the entries are neither sorted nor compared.
    """
    many = entries.groupBy("key", "light").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low != high")
    return entries.join(many.select("key", "light").hint("shuffle_hash"), ["key", "light"], "left_semi").distinct()


def apart(entries: DataFrame, comps: DataFrame | None, turn: int) -> DataFrame:
    """The entries of lists that span components, with their own and a head of another component.

    Each turn shuffles the order of components, so that a head that was refused does not stay one.
    """
    told = entries.withColumn("comp", F.col("sid"))
    if comps is not None:
        told = entries.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    member = F.struct(F.xxhash64(F.lit(turn), "comp").alias("c"), "comp", F.xxhash64(F.lit(turn), "sid").alias("s"), "sid", "n", "rest")
    same = Window.partitionBy("key", "light")
    heads = told.withColumn("low", F.min(member).over(same)).withColumn("high", F.max(member).over(same))
    head = F.when(F.col("comp") == F.col("low.comp"), F.col("high")).otherwise(F.col("low"))
    return heads.where("low.comp != high.comp").withColumn("head", head).drop("low", "high")


def one_each(told: DataFrame, tried: DataFrame | None, percent: int) -> DataFrame:
    """(a, b), at most one for each set: the head that its lists name most often, unless tried before."""
    named = told.selectExpr("sid", "head.sid AS other", "light", "n AS n_a", "head.n AS n_b", "rest AS rest_a", "head.rest AS rest_b")
    named = named.where(may_start(percent)).groupBy("sid", "other").count()
    named = named.select("sid", "other", "count", F.least("sid", "other").alias("b"), F.greatest("sid", "other").alias("a"))
    if tried is not None:
        named = named.join(tried, ["a", "b"], "left_anti")
    best = named.groupBy("sid").agg(F.max(F.struct("count", "a", "b")).alias("x"))
    return best.select("x.a", "x.b").distinct()


def remaining(told: DataFrame, known: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs in one list but in different components that may link, made at their first key."""
    place = F.sort_array(F.collect_list(F.struct((-F.col("rest")).alias("place"), "key", "rest")))
    held = told.groupBy("sid", "n", "comp", "light").agg(place.alias("held")).join(known, "sid")
    before = f"transform(held, (x, i) -> struct(x.key AS key, x.rest AS rest, transform(slice(held, greatest(1, i - {EARLIER - 1}), least(i, {EARLIER})), y -> y.key) AS before))"
    held = held.select("sid", "n", "comp", "light", *PARITY, F.expr(f"inline({before})"))
    left, right = (
        held.select("key", "light", F.col("sid").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "comp", "rest", "before", *PARITY)))
        for s in ("a", "b")
    )
    first = may_start(percent) & may_link(percent) & ~F.arrays_overlap("before_a", "before_b")
    pairs = left.join(right, ["key", "light"]).where((F.col("comp_a") != F.col("comp_b")) & (F.col("a") > F.col("b")) & first)
    return pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")


def near_components(docs: DataFrame, percent: int = 75, k: int = 5, degrees: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, and n_links (other rows that reach the threshold)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tkey"))
    context = docs.sparkSession.sparkContext
    sets = stored(with_sets(docs, k), "sets")
    table = context.broadcast(frequency_levels(docs, k, sets.count()))
    boundary = boundary_of(docs, table, k, percent)
    # Dealt once by list: lists of one set and copies go, and heads are found without another exchange.
    entries = lists_of_many(keys(docs, table, boundary, k, percent).repartition("key", "light"))
    known = sets.where("n > 1").groupBy("sid").agg(*(F.max(c).alias(c) for c in PARITY))
    links = tried = comps = None
    rounds = ROUNDS
    while True:
        told = stored(apart(entries, comps, rounds), "told")
        pairs = stored(one_each(told, tried, percent) if rounds else remaining(told, known, tried, percent), "pairs")
        found = verified(pairs, sets, docs, k, percent)
        links = found if links is None else stored(links.unionByName(found), "all-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        entries = told.select("key", "sid", "n", "light", "rest")
        comps = components(links)
        if not rounds:
            break
        rounds = 0 if found.isEmpty() else rounds - 1
    classes = sets.where("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    degree = stored(partners(comps, classes, sets, docs, k, percent), "partners") if degrees else None
    classes = classes.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    ids = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    classes = classes.join(ids, "comp")
    if degrees:
        classes = classes.join(degree, "sid", "left").withColumn("n_links", F.coalesce("partners", F.lit(0)) + F.col("copies") - 1)
    counted_links = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if degrees else []
    out = sets.join(classes.drop("comp", "least", "copies", "partners"), ["sid", "n"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        *counted_links,
    )
