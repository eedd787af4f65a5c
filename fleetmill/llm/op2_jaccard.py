"""Exact n-gram Jaccard join with signature trees.

1. Each text becomes its set of hashed word shingles (64 bits). Equal sets form a class, found by
   an aggregation on their digests, so copies cost nothing further.
2. Classes are routed by keys. If two sets of at most r shingles reach the threshold T (percent),
   they differ in at most k = 2r(100-T)/(100+T) shingles. Shingles are dealt by hash into more than
   k segments; a differing shingle spoils one segment, so some unspoiled segment is equal in both.
   The hash of each segment is a key (empty ones are left out if more than k remain, with k for the
   largest partner that the set can have). Sets are dealt by size range, and a set near the next
   range's low end also has that range's keys.
3. Each set then needs to keep only its k + 1 rarest keys, by the number of sets that have each, and
   all that are as common as the last of them. Of two linked sets the one that keeps fewer still
   keeps an equal one, which the other then keeps too. A set with more than k keys of its own keeps
   none: nothing can link to it. So passages that many documents share seldom bring sets together.
4. Sets that meet in a kept key are joined by connected components: links can be only inside one.
   Each component is joined with itself by signature trees. A node holds the OR-combined bitmap of
   its sets' hashed shingles (with the most shingles of any one set at each bit) and their size
   range; two trees are traversed together, and a pair of nodes whose largest possible overlap is
   below what their sizes ask for is pruned. Pairs of leaves that remain are compared exactly.
   Components of more than TOKENS shingles are cut into blocks, joined pair by pair in separate
   tasks, so no task holds more than two blocks, however large the component.
5. Links (one spanning tree for each pair of blocks, and each class's number of links) give the
   final components.

Counting every link of a large group of alike sets takes all pairs of its blocks. Where only the
components are asked for (``links=False``), the first set of each kept key is compared with the
key's other sets first: what that joins needs no further comparison, so a group of near copies
costs its size. Trees then join only the sets of those keys that still hold several groups, and
skip pairs of nodes that are of one group.

Texts without words (null, empty, blank) are linked with nothing and are their own component. Rows
with a null doc_id have a set size and a null component and take no part. Rows are the documents:
rows that share a doc_id stand under one number, and each counts among the links of the others. An
empty table gives no rows. Very long texts are read whole; a set is split over nothing, so one set
has to fit a worker (8 bytes a shingle). Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmill.llm.common import Tables, connected_components, join_small, map_texts, read, rows_of
from fleetmill.shipping import ship

THRESHOLD = 90
WORDS = 3
#: Shingles in a block of a large component, and about as many in a group of small ones.
TOKENS = 1 << 17
LEAF, FANOUT = 16, 4
#: Segments beyond k + 1, as a share of it: so many of the commonest need not be kept.
SPARE = 0.25

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * ODD[4]
    x = (x ^ (x >> np.uint64(27))) * ODD[5]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles. Bytes are split at the six ASCII blanks and only
    A-Z are lowered, as the contract has it."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    total = np.full(len(parts) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total + hashes[k : len(parts) - size + 1 + k] * ODD[k % 4])
    return np.unique(total)


def size_ranges(limit: int = 1 << 40) -> list[int]:
    """The largest size of each range."""
    tops = [1]
    while tops[-1] < limit:
        tops.append(max(tops[-1] + 1, tops[-1] * 3 // 2))
    return tops


TOPS = size_ranges()


def dealt(tokens: np.ndarray, threshold: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """For each size range that the set takes part in: the range, its segments, how many keys the set
    has to keep there, and each shingle's segment."""
    n = len(tokens)
    first = bisect_left(TOPS, n)
    for c in range(first, first + (2 if 100 * n >= threshold * (TOPS[first] + 1) else 1)) if n else ():
        differ = 2 * TOPS[c] * (100 - threshold) // (100 + threshold)
        segments = differ + 1 + (max(1, int((differ + 1) * SPARE)) if differ else 0)
        need = (n + min(TOPS[c], 100 * n // threshold)) * (100 - threshold) // (100 + threshold) + 1
        yield c, segments, need, ((tokens >> np.uint64(20)) % np.uint64(segments)).astype(np.int64)


def key_counts(tokens: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """For each size range how many of its keys the set has to keep, and how many it has: those of
    its segments that are not empty if enough are, else all."""
    out = []
    for _, segments, need, at in dealt(tokens, threshold):
        full = int(np.count_nonzero(np.bincount(at, minlength=segments)))
        out.append((need, full) if full >= need else (segments, segments))
    return out


def segment_keys(tokens: np.ndarray, threshold: int = THRESHOLD) -> list[np.ndarray]:
    """For each size range the keys by which the set meets all sets that it may link to."""
    out = []
    for c, segments, need, at in dealt(tokens, threshold):
        order = np.argsort(at, kind="stable")
        counts = np.bincount(at, minlength=segments)
        sums = np.zeros(segments, np.uint64)
        full = np.flatnonzero(counts)
        sums[full] = np.add.reduceat(mixed(tokens[order] + ODD[2]), (np.cumsum(counts) - counts)[full])
        keys = mixed(sums + np.arange(segments, dtype=np.uint64) * ODD[0] + np.full(segments, c, np.uint64) * ODD[3])
        out.append(keys[full] if len(full) >= need else keys)
    return out


class Node:
    """``caps``: for each bit the most shingles any one set has there; the OR-combined bitmap is
    where it isn't 0."""

    __slots__ = ("caps", "low", "high", "children", "members")

    def __init__(self, caps, low, high, children, members):
        self.caps, self.low, self.high, self.children, self.members = caps, low, high, children, members


def build(sets: list[np.ndarray], rows: list[int], bits: int) -> Node:
    """A signature tree over ``sets[rows]``; sets whose smallest hashes are equal, which similar
    ones mostly share, stand side by side."""
    rows = sorted(rows, key=lambda i: (int(sets[i][0]), len(sets[i])))
    nodes = []
    for k in range(0, len(rows), LEAF):
        own = rows[k : k + LEAF]
        caps = np.zeros(bits, np.uint16)
        for i in own:
            np.maximum(caps, np.bincount((sets[i] & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint16), out=caps)
        sizes = [len(sets[i]) for i in own]
        nodes.append(Node(caps, min(sizes), max(sizes), [], own))
    while len(nodes) > 1:
        nodes = [Node(np.maximum.reduce([c.caps for c in g]), min(c.low for c in g), max(c.high for c in g), g, []) for g in (nodes[k : k + FANOUT] for k in range(0, len(nodes), FANOUT))]
    return nodes[0]


def may_link(a: Node, b: Node, threshold: int) -> bool:
    if 100 * a.high < threshold * b.low or 100 * b.high < threshold * a.low:
        return False
    overlap = min(int(np.minimum(a.caps, b.caps).sum(dtype=np.int64)), a.high, b.high)
    return overlap * (100 + threshold) >= threshold * (a.low + b.low)


def compare(sets: list[np.ndarray], left: list[int], right: list[int], threshold: int) -> list[tuple[int, int]]:
    """The linked pairs of two leaves, by their exact intersections."""
    rows = list(dict.fromkeys(left + right))
    tokens, at = np.unique(np.concatenate([sets[i] for i in rows]), return_inverse=True)
    lengths = np.array([len(sets[i]) for i in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    shared = np.zeros((len(rows), len(rows)), np.int64)
    for k in range(0, len(tokens), 1 << 16):  # so that the matrix stays small for long texts
        part = (at >= k) & (at < k + (1 << 16))
        m = np.zeros((len(rows), min(1 << 16, len(tokens) - k)), np.float32)
        m[owner[part], at[part] - k] = 1
        shared += np.rint(m @ m.T).astype(np.int64)
    linked = 100 * shared >= threshold * (lengths[:, None] + lengths[None, :] - shared)
    place = {i: k for k, i in enumerate(rows)}
    same = left == right
    return [(i, j) for x, i in enumerate(left) for j in (right[x + 1 :] if same else right) if linked[place[i], place[j]]]


class Groups:
    """Union-find over rows."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, j: int) -> None:
        p, q = self.top(i), self.top(j)
        self.root[max(p, q)] = min(p, q)

    def one(self, rows: list[int]) -> bool:
        first = self.top(rows[0])
        return all(self.top(i) == first for i in rows)


def join_trees(sets: list[np.ndarray], left: list[int], right: list[int] | None = None, threshold: int = THRESHOLD, groups: Groups | None = None, take: Callable[[list[tuple[int, int]]], None] | None = None) -> list[tuple[int, int]]:
    """All linked pairs between ``left`` and ``right``, or inside ``left`` if there is no right. With
    ``groups``, links join these, and leaves that are already of one group are not compared. With
    ``take``, each two leaves' links go there at once and none are returned: a group of alike sets
    has as many as pairs."""
    if not left or right == []:
        return []
    largest = max((len(sets[i]) for i in left + (right or [])), default=0)
    if not largest:
        return []
    bits = 1 << min(16, max(6, (2 * largest - 1).bit_length()))
    a = build(sets, left, bits)
    b = a if right is None else build(sets, right, bits)
    found, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if x is not y and not may_link(x, y, threshold):
            continue
        if x.members and y.members:
            if groups is None or not groups.one(x.members + y.members):
                links = compare(sets, x.members, y.members, threshold)
                if take:
                    take(links)
                else:
                    found += links
                for i, j in links if groups is not None else ():
                    groups.join(i, j)
        elif x is y:
            todo += [(p, q) for k, p in enumerate(x.children) for q in x.children[k:]]
        elif x.members:
            todo += [(x, q) for q in y.children]
        elif y.members:
            todo += [(p, y) for p in x.children]
        else:
            todo += [(p, q) for p in x.children for q in y.children]
    return found


def _sets(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.asarray(x, np.int64).view(np.uint64) for x in pdf["tokens"]]


def _join_block(threshold: int, counting: bool):
    """One group of small components, or a pair of blocks of a large one: each set's root among the
    sets linked there and, if ``counting``, its number of links. Sets that share a ``known`` group
    count as joined."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["component", "node", "d1"], ignore_index=True)  # repeated rows
        sets, nodes, copies, subs = _sets(pdf), pdf["node"].tolist(), pdf["copies"].tolist(), pdf["sub"].tolist()
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        groups = Groups(len(nodes))
        for rows in pdf.groupby("known").indices.values():
            for i in rows[1:].tolist():
                groups.join(int(rows[0]), i)
        own = None if counting else groups
        degree = [0] * len(nodes)

        def take(links: list[tuple[int, int]]) -> None:
            for i, j in links:
                degree[i] += copies[j]
                degree[j] += copies[i]
                groups.join(i, j)

        if low == high:
            for rows in pdf.groupby("component").indices.values():
                join_trees(sets, rows.tolist(), None, threshold, own, take)
        else:
            join_trees(sets, [i for i, s in enumerate(subs) if s == low], [i for i, s in enumerate(subs) if s == high], threshold, own, take)
        return pd.DataFrame({"node": nodes, "root": [nodes[groups.top(i)] for i in range(len(nodes))], "degree": degree})

    return run


def _compare_first(threshold: int):
    """Links between sets and the first set of a key that they are in."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["first", "node", "d1"], ignore_index=True)  # repeated rows
        sets, nodes, out = _sets(pdf), pdf["node"].tolist(), []
        for rows in pdf.groupby("first").indices.values():
            firsts = [i for i in rows.tolist() if nodes[i] == pdf["first"].iat[i]]
            for i in rows.tolist():
                for f in firsts:
                    if nodes[i] != nodes[f] and 100 * min(len(sets[i]), len(sets[f])) >= threshold * max(len(sets[i]), len(sets[f])):
                        both = len(np.intersect1d(sets[i], sets[f], assume_unique=True))
                        if 100 * both >= threshold * (len(sets[i]) + len(sets[f]) - both):
                            out.append((nodes[i], nodes[f]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def digests(tokens: np.ndarray) -> tuple[int, int, int]:
    """Two of a set, and an even number made of them that stands for it where keys are dealt. (Sets
    that got the same number would only be compared in vain.)"""
    if not len(tokens):
        return 0, 0, 0
    d1, d2 = tokens.sum(), mixed(tokens).sum()
    pair = np.array([d1, d2], np.uint64)  # an array wraps around without a warning
    both = mixed((pair * ODD[0])[1:] + pair[:1]) & ~np.uint64(1)
    return int(d1.view(np.int64)), int(d2.view(np.int64)), int(both.view(np.int64)[0])


def keys_of(texts: DataFrame, threshold: int, words: int) -> DataFrame:
    """``(key, owner)`` of all keys; an owner is its set's number plus the place of the size range."""

    def rows(cols: dict[str, list]) -> dict[str, list]:
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for text in cols["text"]:
            tokens = shingle_set(text, words)
            number = digests(tokens)[2]
            for k, own in enumerate(segment_keys(tokens, threshold)):
                keys.append(own)
                owners.append(np.full(len(own), number + k))
        return {"key": np.concatenate(keys).view(np.int64), "owner": np.concatenate(owners)}

    return map_texts(texts, rows, "key long, owner long")


#: Keys are held to be very common if so many rows of one in SAMPLED of the documents have them.
SAMPLED, COMMON = 64, 1000


def kept_keys(texts: DataFrame, classes: DataFrame, threshold: int, words: int, tables: Tables) -> DataFrame:
    """``(a, key, b)``: the keys that sets (named by their smallest doc_id) keep and share with
    another one, and the first set that keeps each. Keys are dealt by a shuffle and counted there,
    but for very common ones, which a fixed share of the documents tells: these are counted by a
    map-side aggregation, so none is gathered, and either way gives the same."""
    texts = texts.where("doc_id is not null and text is not null")
    few = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)
    common = tables.put(keys_of(few.select("text"), threshold, words).groupBy("key").count().where(F.col("count") >= COMMON).select("key"))
    n_common = rows_of(common)
    one = keys_of(texts.select("text"), threshold, words)
    number = F.col("owner").bitwiseAND(-2)
    counts = {"sets": F.count(F.lit(1)), "low": F.min(number), "high": F.max(number)}
    of_key = W.partitionBy("key")
    rest = join_small(one, common, "key", "left_anti", n_common) if n_common else one
    met = rest.withColumns({name: c.over(of_key) for name, c in counts.items()}).where("low <> high")
    if n_common:
        hot = join_small(one, common, "key", "left_semi", n_common)
        counted = tables.put(hot.groupBy("key").agg(*[c.alias(name) for name, c in counts.items()]).where("low <> high"))
        met = met.unionByName(join_small(hot, counted, "key", "inner"), allowMissingColumns=True)
    met = tables.put(met.select("key", "owner", "sets").distinct())
    place = F.col("owner").bitwiseAND(1)
    sized = met.withColumn("number", number).join(classes.select("number", F.col("rep").alias("a"), "ranges"), "number").withColumn("range", F.get("ranges", place.cast("int")))
    of_set = W.partitionBy("a", "owner")  # the keys of one set
    ranked = sized.withColumn("rank", F.rank().over(of_set.orderBy("sets"))).withColumn("met", F.count(F.lit(1)).over(of_set))
    kept = tables.put(ranked.where(F.col("rank") <= F.col("range.need") - (F.col("range.n_keys") - F.col("met"))).select("a", "key").distinct())
    first = tables.put(kept.groupBy("key").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("sets")).where("sets > 1").drop("sets"))
    return tables.put(join_small(kept, first, "key", "inner"))


def jaccard_components(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, links: bool = True) -> DataFrame:
    """``docs(doc_id long, text)`` -> ``(doc_id, n_shingles, component_id, n_links)``: the distinct
    shingles, the smallest doc_id reachable by links, and the documents linked directly (left out
    without ``links``)."""
    spark = docs.sparkSession
    ship(spark)
    tables = Tables()

    def hash_rows(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("n", "d1", "d2", "number", "ranges")}
        for text in cols["text"]:
            tokens = shingle_set(text, words)
            for name, value in zip(out, (len(tokens), *digests(tokens), [{"need": need, "n_keys": n} for need, n in key_counts(tokens, threshold)]), strict=True):
                out[name].append(value)
        return {"doc_id": cols["doc_id"], **out}

    texts = docs.select("doc_id", "text")
    hashed = tables.put(map_texts(texts, hash_rows, "doc_id long, n long, d1 long, d2 long, number long, ranges array<struct<need:int,n_keys:int>>"))
    digest = ["n", "d1", "d2"]
    classes = tables.put(hashed.where("n > 0 and doc_id is not null").groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("number").alias("number"), F.first("ranges").alias("ranges")))
    meeting = kept_keys(texts, classes, threshold, words, tables)
    stars = tables.put(meeting.where("a <> b").select("a", "b").distinct())

    def with_sets(rows: DataFrame, schema: str, total: int) -> DataFrame:
        """Rows of (node, n, d1, …) with the node's shingles, hashed again from its text."""
        names = [c.split()[0] for c in schema.split(", ")]

        def run(cols: dict[str, list]) -> dict[str, list]:
            sets = [shingle_set(t, words) for t in cols["text"]]
            own = [k for k, s in enumerate(sets) if len(s) == cols["n"][k] and int(s.sum().view(np.int64)) == cols["d1"][k]]
            return {c: [cols[c][k] for k in own] for c in names} | {"tokens": [sets[k].view(np.int64) for k in own]}

        joined = join_small(texts.withColumnRenamed("doc_id", "node"), rows, "node", "inner", total)
        return map_texts(joined, run, schema + ", tokens array<long>")

    slim = classes.select(F.col("rep").alias("node"), "n", "d1", "copies")
    known = None
    if not links:
        ends = tables.put(stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node"))).distinct().join(slim, "node"))
        sets = tables.put(with_sets(ends, "node long, d1 long", rows_of(ends)))
        # a first set stands in as many parts as its key's other sets need, of about TOKENS shingles each
        spokes = stars.select(F.col("b").alias("first"), F.col("a").alias("node")).join(ends.select("node", "n"), "node")
        parts = spokes.groupBy("first").agg(F.ceil(F.sum("n") / TOKENS).cast("long").alias("parts"), F.sum("n").alias("size"))
        parts = tables.put(parts)
        groups = max(1, (parts.agg(F.sum("size")).first()[0] or 0) // TOKENS)
        group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("first"), F.lit(groups))).otherwise(F.xxhash64("first", "part"))
        parted = spokes.select("first", "node").join(parts, "first").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
        own = parts.select("first", F.col("first").alias("node"), "parts", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        rows = parted.select("first", "node", "parts", "part").unionByName(own.select("first", "node", "parts", "part")).withColumn("group", group)
        checked = rows.join(sets, "node").groupBy("group", F.when(F.col("parts") > 1, F.struct("first", "part"))).applyInPandas(_compare_first(threshold), "a long, b long")
        known = connected_components(tables.put(checked), tables)
        # what is not yet joined: keys whose sets are of several groups
        of_known = lambda c: F.coalesce("component", c)
        labelled = tables.put(join_small(meeting, known.withColumnRenamed("node", "a"), "a", "left", rows_of(known)).select("a", "key", of_known("a").alias("label")))
        several = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        open_keys = tables.put(join_small(labelled, tables.put(several.select("key", "low")), "key", "inner"))
        blocks = connected_components(open_keys.select(F.col("label").alias("a"), F.col("low").alias("b")).distinct(), tables)
        nodes = open_keys.select(F.col("a").alias("node"), F.col("label").alias("known")).distinct()
        members = slim.join(nodes, "node").join(blocks.withColumnRenamed("node", "known"), "known")
    else:
        members = slim.join(connected_components(stars, tables), "node").withColumn("known", F.col("node"))

    sizes = tables.put(members.groupBy("component").agg(F.sum("n").alias("size")))
    members = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("size") / TOKENS).cast("long"))
    members = members.withColumn("sub", F.pmod(F.xxhash64("node"), F.col("parts")))
    members = tables.put(members.select("component", "node", "known", "n", "d1", "copies", "parts", "sub"))
    total, shingles = rows_of(members), sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sets = with_sets(members, "component long, node long, known long, d1 long, copies long, parts long, sub long", total)
    pairs = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.withColumns({"low": F.least("sub", "other"), "high": F.greatest("sub", "other")})
    # small components share groups, so that a group is worth its call
    group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(max(1, shingles // TOKENS)))).otherwise(F.xxhash64("component", "low", "high"))
    joined = pairs.withColumn("group", group).groupBy("group", F.when(F.col("parts") > 1, F.struct("component", "low", "high"))).applyInPandas(_join_block(threshold, links), "node long, root long, degree long")
    joined = tables.put(joined.groupBy("node", "root").agg(F.sum("degree").alias("degree")))

    found_edges = joined.select(F.col("node").alias("a"), F.col("root").alias("b"))
    if known is not None:
        found_edges = found_edges.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    found = connected_components(found_edges, tables)
    degrees = joined.groupBy("node").agg(F.sum("degree").alias("degree"))
    of_class = classes.drop("ranges", "number").join(found.withColumnRenamed("node", "rep"), "rep", "left").join(degrees.withColumnRenamed("node", "rep"), "rep", "left")
    out = hashed.drop("ranges", "number").join(of_class, digest, "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    columns = {
        "doc_id": F.col("doc_id"),
        "n_shingles": F.col("n"),
        "component_id": F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep")),
        "n_links": F.when(alone, 0).otherwise(F.col("copies") - 1 + F.coalesce("degree", F.lit(0))),
    }
    return tables.finish(out.select(*[c.alias(name) for name, c in columns.items() if links or name != "n_links"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id,
  (SELECT count(*) FROM l WHERE l.a = d.doc_id)::BIGINT AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id
"""
