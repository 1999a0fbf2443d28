"""Exact Jaccard join on word shingles with a token-group matrix.

A text's set holds the hashes of its distinct word shingles; texts with equal sets form a class and go on as one. The join
finds which classes are connected by links of at least the wanted similarity:

* All sets order their shingles alike, rare ones first, by a sketch of fixed size that counts every shingle of the corpus.
  Two linked sets must share one of their first (1 - similarity) * size + 1 shingles, so only these prefixes are matched.
* Similar classes are put into groups: each goes to the smallest class that it shares most prefix shingles with, its
  leader, by steps of 5 % in size, and large groups are split. The matrix holds, for every group, the union of its members'
  *prefix* shingles (sharper than the union of all) and the range of sizes.
* From how many shingles of a union a class holds, and the sizes, follows a bound on the overlap with any member; only
  groups where it suffices are opened. There the sets themselves are compared.
* Each group is opened for its own members first; if a family was split, its smallest class is a guest in all its groups.
  What this connects is one block; then only groups of different blocks meet. So a cluster of near copies costs in
  proportion to its rows. Two large clusters that are similar and not linked are compared group by group.
* From an opened group come no pairs but a forest that connects what is linked; components follow by passing the smallest
  id along stars, each round a written table.

Words are runs of characters other than ASCII white space, A to Z in lower case. A text with fewer words than a shingle is
one shingle; texts without words, or null, have an empty set and are linked with nothing. Rows with a null id belong to no
component and link nothing. Rows that repeat an id are one document as far as links go; equal texts are one class. An empty
table gives an empty result. Very long texts make large sets, which are compared in slices. Only named columns are read.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.session import work_path

_U = np.uint64
#: Counters of the sketch (4 bytes each) and how many rows they are summed up in.
COUNTERS, SLICES = 1 << 20, 64
_SHIFT = _U(44)  # leaves as many bits of a hash as number the counters
#: Ids (8 bytes each) up to which a list of them is broadcast; longer lists are joined by shuffling.
BROADCAST_IDS = 1_000_000
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = np.ones(1, np.uint64)


def _powers(count: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < count:
        _POWERS = np.concatenate([[_U(1)], np.cumprod(np.full(2 * count, 0x9E3779B97F4A7C15, np.uint64))])
    return _POWERS


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    solid = ~_BLANK[data]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1 if len(solid) else np.empty(0, np.int64)
    if len(solid) and solid[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(solid))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    letters = data[solid].astype(np.uint64) + _U(1)
    sizes = ends - starts
    heads = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(heads, sizes)
    hashed = _mix(np.add.reduceat(letters * _powers(int(sizes.max()))[place], heads) + sizes.astype(np.uint64))
    take = min(words, len(hashed))
    total = np.full(len(hashed) - take + 1, take, np.uint64)
    for i in range(take):
        total = _mix(total * _U(0xD6E8FEB86659FD93) + hashed[i : len(hashed) - take + 1 + i])
    return np.unique(total)


def prefix_size(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How often shingles fall on each counter, over all texts. What reaches the driver is COUNTERS numbers."""
    width = COUNTERS // SLICES

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, (shingle_set(text, words) >> _SHIFT).astype(np.int64), 1)
        part = TaskContext.get().partitionId() % 256
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        rows = [(i, part, total[i * width : (i + 1) * width].tobytes()) for i in range(SLICES)]
        yield pd.DataFrame(rows, columns=["slice", "part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, np.uint32).astype(np.int64) for c in rows["counts"]], axis=0)
        return rows.iloc[:1].assign(counts=np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes())

    shape = "slice int, part int, counts binary"
    parts = docs.where("text is not null").select("text").mapInPandas(count, shape)
    summed = parts.groupBy("slice", "part").applyInPandas(add, shape).groupBy("slice").applyInPandas(add, shape)
    found = {r["slice"]: np.frombuffer(r["counts"], np.uint32) for r in summed.collect()}
    return np.concatenate([found.get(i, np.zeros(width, np.uint32)) for i in range(SLICES)])


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder. What the step has shuffled is of no use then; Spark deletes such files when
    the driver collects its garbage, which is asked for here, so that disk holds one step's files at a time."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def signatures(docs: DataFrame, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """doc_id, size, a 128-bit hash of the set (one, two) and its prefix."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                own = shingle_set(text or "", words)
                one, two = _mix(own).sum(), _mix(own ^ _U(0x5851F42D4C957F2D)).sum()
                order = np.lexsort((own, counts[(own >> _SHIFT).astype(np.int64)]))[: prefix_size(len(own), percent) if len(own) else 0]
                out.append((doc, len(own), one.astype(np.int64), two.astype(np.int64), own[order].view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "size", "one", "two", "prefix"])

    ids = F.col("doc_id").cast("decimal(20,0)").alias("doc_id")
    shape = "doc_id decimal(20,0), size long, one long, two long, prefix array<long>"
    return docs.select(ids, "text").mapInPandas(sign, shape).withColumn("doc_id", F.col("doc_id").cast("long"))


def _reaches(size: Column, other: Column, hits: Column, percent: int) -> Column:
    """Whether sets of these sizes can be linked if their prefixes share ``hits`` shingles at most."""
    share = percent / (100.0 + percent)
    return hits >= share * (size + other) - percent / 100.0 * F.greatest(size, other) - 1e-6


def open_groups(asked: pd.DataFrame, members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A forest over the links between the asking classes and the members of an opened group."""
    columns = ["a", "b"]
    if not len(asked) or not len(members):
        return pd.DataFrame(columns=columns).astype("int64")
    left, right = ([np.frombuffer(t, np.uint64) for t in side] for side in (asked["tokens"], members["member_tokens"]))
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*flat)
    rows = [np.repeat(np.arange(len(s)), s) for s in sizes]
    where = [np.searchsorted(common, f) for f in flat]
    for i in (0, 1):
        hit = where[i] < len(common)
        hit[hit] = common[where[i][hit]] == flat[i][hit]
        rows[i], where[i] = rows[i][hit], where[i][hit]
    shared = np.zeros((len(left), len(right)), np.float64)
    step = 8_192
    for lo in range(0, len(common), step):
        parts = []
        for i, side in ((0, left), (1, right)):
            own = (where[i] >= lo) & (where[i] < lo + step)
            part = np.zeros((len(side), min(step, len(common) - lo)), np.float32)
            part[rows[i][own], where[i][own] - lo] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    a, b = np.nonzero(100 * shared >= percent * union)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(asked["rep"].to_numpy(np.int64)[a].tolist(), members["member_rep"].to_numpy(np.int64)[b].tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return pd.DataFrame(out, columns=columns).astype("int64")


def components(links: DataFrame) -> DataFrame:
    """id and root, the smallest id reachable over ``links`` (a, b), of every id with a link. Alternates large and small
    stars: each id passes the smallest id it knows to its larger, then to its smaller neighbours."""
    edges = _written(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")

    def told(both: DataFrame) -> DataFrame:
        """both: (id, near). Adds the smallest of each id and what it is near."""
        least = both.groupBy(F.col("id").alias("of")).agg(F.least(F.min("near"), F.col("of")).alias("least"))
        return both.join(least, F.col("id") == F.col("of"))

    mark = None
    while True:
        forth = edges.select(F.col("v").alias("id"), F.col("u").alias("near"))
        large = told(forth.unionAll(edges.select(F.col("u").alias("id"), F.col("v").alias("near"))))
        large = large.where("near > id").select(F.col("near").alias("v"), F.col("least").alias("u")).distinct()
        down = large.where("v <> u").select(F.col("v").alias("id"), F.col("u").alias("near"))
        small = told(down)
        small = small.select(F.col("near").alias("v"), F.col("least").alias("u")).unionAll(small.select(F.col("id").alias("v"), F.col("least").alias("u")))
        edges = _written(small.where("v <> u").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("root"))
        mark = now


def shared_shingles(classes: DataFrame) -> DataFrame:
    """token, rep, least: the prefix shingles that several classes hold, each with the smallest of these. Counted with
    partial sums, so that no task has to hold all holders of a common shingle."""
    rows = classes.select("rep", F.explode("prefix").alias("token"))
    held = rows.groupBy(F.col("token").alias("of")).agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    return rows.join(held, F.col("token") == F.col("of")).select("token", "rep", "least")


def groups(shared: DataFrame, classes: DataFrame, group_rows: int, group_tokens: int) -> DataFrame:
    """rep, size, group and hub. Classes with the same leader and sizes within 5 % are a family; families over
    ``group_rows`` classes or ``group_tokens`` shingles are split into several groups, and their smallest class is
    the hub of each."""
    nearest = shared.groupBy("rep", "least").agg(F.count("*").alias("n"))
    leaders = nearest.groupBy("rep").agg(F.max_by("least", F.struct(F.col("n"), -F.col("least"))).alias("leader"))
    sizes = classes.groupBy(F.col("rep").alias("id")).agg(F.max("size").alias("size"))
    leaders = leaders.join(sizes, F.col("rep") == F.col("id")).drop("id")
    # Members of a group differ by a few per cent in size: the narrower its range, the sharper the bound.
    leaders = _written(leaders.withColumn("family", F.xxhash64("leader", F.floor(F.log("size") / math.log(1.05)))), "leaders")
    parts = leaders.groupBy(F.col("family").alias("of")).agg(F.ceil(F.greatest(F.count("*") / group_rows, F.sum("size") / group_tokens)).alias("parts"), F.min("rep").alias("hub"))
    parts = _written(parts.where("parts > 1"), "parts")
    if parts.count() <= BROADCAST_IDS:
        parts = F.broadcast(parts)  # three numbers a family; a large family need not come together to be split
    split = leaders.join(parts, F.col("family") == F.col("of"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return _written(split.select("rep", "size", "hub", F.xxhash64("family", F.pmod(F.xxhash64("rep"), "parts")).alias("group")), "groups")


def _enough(met: DataFrame, percent: int) -> DataFrame:
    """The rows of ``met`` (size, hits, low, high) where a set of this size may be linked with one of size low to high."""
    fits = (100 * F.col("high") >= percent * F.col("size")) & (percent * F.col("low") <= 100 * F.col("size"))
    size = F.col("size").cast("double")
    ends = [F.greatest(F.col("low").cast("double"), size * percent / 100), F.least(F.col("high").cast("double"), size * 100 / percent)]
    return met.where(fits & (_reaches(size, ends[0], F.col("hits"), percent) | _reaches(size, ends[1], F.col("hits"), percent)))


def _bounds() -> tuple[Column, ...]:
    return F.min("size").alias("low"), F.max("size").alias("high"), F.count("*").alias("holders")


def within(shared: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """rep, group: the classes whose own group is opened for them. The hub of a split family sits in all of its groups, so
    that groups of one large cluster are connected through it; each row meets its own group only."""
    home = grouped.select("rep", "size", "group")
    seats = grouped.select("group", F.col("hub").alias("of")).where("of is not null").distinct().join(home.select("rep", "size"), F.col("rep") == F.col("of"))
    seats = home.unionByName(seats.select("rep", "size", "group")).distinct().withColumnRenamed("rep", "id")
    told = shared.join(seats, F.col("rep") == F.col("id")).select("token", "rep", "size", "group")
    matrix = told.groupBy(F.col("token").alias("of"), F.col("group").alias("other")).agg(*_bounds()).where("holders > 1")
    met = told.join(matrix, (F.col("token") == F.col("of")) & (F.col("group") == F.col("other")))
    met = met.groupBy("rep", "size", "group").agg(F.count("*").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    return _enough(met, percent).select("rep", "group")


def between(shared: DataFrame, grouped: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """rep, group, block, other: the classes that may be linked with a class of block ``other``. A block is a component
    so far, as far as whole groups belong to it, or else a group. Shingles that one block alone holds fall away before
    anything is joined, so a cluster that is one component by now costs nothing, however large."""
    placed = grouped.select("rep", "size", "group").join(roots, F.col("rep") == F.col("id"), "left").withColumn("root", F.coalesce("root", "rep")).drop("id")
    pure = placed.groupBy(F.col("group").alias("of")).agg(F.min("root").alias("first"), F.max("root").alias("last"))
    placed = placed.join(pure, F.col("group") == F.col("of"))
    block = F.when(F.col("first") == F.col("last"), F.xxhash64("root")).otherwise(F.col("group"))
    placed = placed.select(F.col("rep").alias("id"), "size", "group", "root", block.alias("block"))
    told = shared.join(placed, F.col("rep") == F.col("id")).select("token", "rep", "size", "group", "root", "block")
    several = told.groupBy(F.col("token").alias("met")).agg(F.min("block").alias("one"), F.max("block").alias("two")).where("one <> two").select("met")
    told = _written(told.join(several, F.col("token") == F.col("met"), "left_semi"), "told")
    matrix = told.groupBy(F.col("token").alias("of"), F.col("block").alias("other")).agg(*_bounds(), F.min("root").alias("first"), F.max("root").alias("last"))
    apart = (F.col("block") != F.col("other")) & ((F.col("first") != F.col("root")) | (F.col("last") != F.col("root")))
    met = told.join(matrix, (F.col("token") == F.col("of")) & apart)
    met = met.groupBy("rep", "size", "group", "block", "other").agg(F.count("*").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    return _enough(met, percent).select("rep", "group", "block", "other")


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id, tokens: the whole sets of the classes ``ids`` (rep)."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["doc_id"], "tokens": [shingle_set(t, words).tobytes() for t in batch["text"]]})

    needed = _written(ids.select(F.col("rep").alias("id")).distinct(), "needed")
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)  # else all texts would be shuffled to meet a few ids
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(needed, F.col("doc_id") == F.col("id"), "left_semi")
    return _written(texts.mapInPandas(gather, "id long, tokens binary"), "sets")


def connected(docs: DataFrame, classes: DataFrame, words: int, percent: int, group_rows: int = 256, group_tokens: int = 400_000) -> DataFrame:
    """id, root: the smallest class reachable by links, of every class with a link. ``classes``: rep, size, prefix.

    Each group is opened for its own members first. What that connects is one block from then on, and only groups of
    different blocks that may be linked are opened in pairs."""
    shared = _written(shared_shingles(classes), "shared")
    grouped = groups(shared, classes, group_rows, group_tokens)

    own = _written(within(shared, grouped, percent), "qualified")
    opened = own.join(sets_of(docs, own, words), F.col("rep") == F.col("id")).select("group", "rep", "tokens")

    def open_one(rows: pd.DataFrame) -> pd.DataFrame:
        return open_groups(rows, rows.rename(columns={"rep": "member_rep", "tokens": "member_tokens"}), percent)

    first = components(opened.groupBy("group").applyInPandas(open_one, "a long, b long"))

    # Two linked classes qualify for each other's blocks, so groups are opened in pairs with those of either side that do.
    apart = _written(between(shared, grouped, first, percent), "qualified")
    sides = apart.where("block < other").select("group", "block", "other").distinct()
    facing = apart.where("block > other").select(F.col("group").alias("member_group"), F.col("other").alias("_block"), F.col("block").alias("_other")).distinct()
    pairs = _written(sides.join(facing, (F.col("block") == F.col("_block")) & (F.col("other") == F.col("_other"))).select("group", "member_group", "block", "other"), "pairs")
    full = apart.join(sets_of(docs, apart, words), F.col("rep") == F.col("id")).select(F.col("group").alias("of"), F.col("block").alias("own"), F.col("other").alias("met"), "rep", "tokens")
    asked = pairs.join(full, (F.col("group") == F.col("of")) & (F.col("other") == F.col("met"))).select("group", "member_group", "rep", "tokens")
    members = pairs.join(full, (F.col("member_group") == F.col("of")) & (F.col("block") == F.col("met")))
    members = members.select(F.col("group").alias("g"), F.col("member_group").alias("m"), F.col("rep").alias("member_rep"), F.col("tokens").alias("member_tokens"))
    more = asked.groupBy("group", "member_group").cogroup(members.groupBy("g", "m")).applyInPandas(lambda a, m: open_groups(a, m, percent), "a long, b long")

    # Links between components, each under the name of its smallest id.
    for side in ("a", "b"):
        named = first.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        more = more.join(named, F.col(side) == F.col("_id"), "left").withColumn(side, F.coalesce("_root", side)).select("a", "b")
    second = components(more).select(F.col("id").alias("_id"), F.col("root").alias("_root"))
    both = first.join(second, F.col("root") == F.col("_id"), "left").select("id", F.coalesce("_root", "root").alias("root"))
    alone = second.join(first.select("id"), F.col("_id") == F.col("id"), "left_anti").select(F.col("_id").alias("id"), F.col("_root").alias("root"))
    return both.unionByName(alone)


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that the document is connected with, its own included."""
    signed = _written(signatures(docs, words, percent, sketch(docs, words)), "signed")
    solid = signed.where("size > 0 and doc_id is not null")
    classes = solid.groupBy("one", "two").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    classes = _written(classes, "classes")
    roots = connected(docs, classes.drop("one", "two"), words, percent)
    named = classes.select(F.col("one").alias("_one"), F.col("two").alias("_two"), "rep").join(roots, F.col("rep") == F.col("id"), "left")
    named = named.select("_one", "_two", F.coalesce("root", "rep").alias("root"))
    told = signed.join(named, (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")) & (F.col("size") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("root", "doc_id"), "doc_id"))
    return told.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
