"""SimHash near-duplicates over a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components
from lexmill.llm.words import ROW, whole_rows
from lexmill.operators.scratch import materialized

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Shingles hashed at a time, so that memory does not grow with a text.
SHINGLE_BLOCK = 8192
#: Fingerprints wanted in a group, and the most groups: the upper nodes that each task gets are so many at most.
GROUP_SIZE = 16_384
MAX_GROUPS = 4096
#: Children of an index node, and fingerprints looked up at a time.
FANOUT = 8
LOOKUPS = 512


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of word shingles, repeats included; no words: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    n = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, SHINGLE_BLOCK):
        b = min(n, a + SHINGLE_BLOCK)
        spans = zip(starts[a:b].tolist(), ends[a + width - 1:b + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def simhash(text: Column | str, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint as a signed long with the same 64 bits; null and blank texts: zero."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint_of(t, shingle_words) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return fingerprints(F.col(text) if isinstance(text, str) else text)


def as_hex(fingerprint: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def gray_rank(fingerprint: Column | str) -> Column:
    """Place of a fingerprint among all words in Gray order, as a long that sorts like it."""
    rank = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Tree over neighbours in Gray order; a node holds the bits that all below it share.

    ``fresh`` are the shared bits that the node's parent does not have, so a search
    adds up differences on its way down and leaves whole groups once they exceed
    the radius.
    """

    def __init__(self, every: np.ndarray, some: np.ndarray) -> None:
        """``every``: bits set in all members of a leaf; ``some``: bits set in any."""
        levels = [(every, some)]
        while len(levels[-1][0]) > 1:
            e, s = levels[-1]
            cuts = np.arange(0, len(e), FANOUT)
            levels.append((np.bitwise_and.reduceat(e, cuts), np.bitwise_or.reduceat(s, cuts)))
        self.levels = []
        above = None
        for e, s in reversed(levels):
            mask = ~(e ^ s)
            fresh = mask if above is None else mask & ~above[np.arange(len(e)) // FANOUT]
            self.levels.append((e, fresh))
            above = mask

    @classmethod
    def of_fingerprints(cls, fingerprints: np.ndarray) -> GrayIndex:
        return cls(fingerprints, fingerprints)

    def search(self, queries: np.ndarray, radius: int, fixed: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) numbers of all leaves whose shared bits differ in ``radius`` at most, and in none of ``fixed``."""
        at = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        apart = np.zeros(len(queries), np.uint8)
        for depth, (pattern, fresh) in enumerate(self.levels):
            if depth:
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                there = child < len(pattern)
                at, apart, node = np.repeat(at, FANOUT)[there], np.repeat(apart, FANOUT)[there], child[there]
            other = (queries[at] ^ pattern[node]) & fresh[node]
            apart = apart + np.bitwise_count(other)
            near = (apart <= radius) & (other & fixed == 0)
            at, node, apart = at[near], node[near], apart[near]
        return at, node


def _roots(label: np.ndarray, x: np.ndarray) -> np.ndarray:
    r = label[x]
    while True:
        up = label[r]
        if np.array_equal(up, r):
            return r
        r = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; labels lead to the smallest member."""
    while len(a):
        ra, rb = _roots(label, a), _roots(label, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def _links_of_group(members: np.ndarray, index: GrayIndex, radius: int, fixed: np.uint64) -> np.ndarray:
    """First member of each member's set after all links inside the group, found by looking up each member."""
    label = np.arange(len(members))
    for a in range(0, len(members), LOOKUPS):
        at, leaf = index.search(members[a:a + LOOKUPS], radius, fixed)
        at = at + a
        later = at < leaf
        _unite(label, at[later], leaf[later])
    return _roots(label, label)


def _visits(first_blocks: np.ndarray, every: np.ndarray, mask: np.ndarray, width: int, radius: int):
    """Send a fingerprint to its own group, and to later groups that begin with its block and may hold a neighbour."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, own = batch["fp"].to_numpy().view(np.uint64), batch["grp"].to_numpy()
            yield pd.DataFrame({"home": own, "guest": False, "fp": fps.view(np.int64), "turn": batch["turn"]})
            block = _turn_block(batch["turn"].to_numpy(), fps, width)
            last = np.searchsorted(first_blocks, block, "right")
            at, home = np.arange(len(fps)), own + 1
            while len(at := at[home[at] < last[at]]):
                h = home[at]
                near = (first_blocks[h] == block[at]) & (np.bitwise_count((fps[at] ^ every[h]) & mask[h]) <= radius)
                yield pd.DataFrame({
                    "home": h[near].astype(np.int32), "guest": True, "fp": fps[at[near]].view(np.int64), "turn": batch["turn"].to_numpy()[at[near]]})
                home[at] += 1

    return send


def _match_groups(radius: int, width: int):
    """Rows sorted by (home, guest): index the members of a home, then look up its guests batch by batch."""
    fixed = ~np.uint64((1 << 64 - width) - 1)

    def links(a: np.ndarray, b: np.ndarray, turn: int) -> pd.DataFrame:
        left, right = np.uint64(64 - turn), np.uint64(turn)
        back = lambda x: (x << left | x >> right) if turn else x
        return pd.DataFrame({"a": back(a).view(np.int64), "b": back(b).view(np.int64)})

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        home, turn, parts, members, index, root = None, 0, [], None, None, None

        def finish() -> tuple[np.ndarray, GrayIndex, np.ndarray]:
            found = np.concatenate(parts)
            tree = GrayIndex.of_fingerprints(found)
            return found, tree, _links_of_group(found, tree, radius, fixed)

        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            homes, guests, turns = batch["home"].to_numpy(), batch["guest"].to_numpy(), batch["turn"].to_numpy()
            cuts = np.flatnonzero((homes[1:] != homes[:-1]) | (guests[1:] != guests[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(fps)], strict=True):
                if a == b:
                    continue
                if homes[a] != home:
                    if parts and index is None:
                        members, index, root = finish()
                        yield links(members, members[root], turn)
                    home, turn, parts, index = homes[a], int(turns[a]), [], None
                if not guests[a]:
                    parts.append(fps[a:b])
                    continue
                if index is None:
                    members, index, root = finish()
                    yield links(members, members[root], turn)
                for c in range(a, b, LOOKUPS):
                    some = fps[c:min(b, c + LOOKUPS)]
                    at, leaf = index.search(some, radius, fixed)
                    pairs = np.unique(np.stack([at, root[leaf]]), axis=1)
                    yield links(some[pairs[0]], members[pairs[1]], turn)
        if parts and index is None:
            members, index, root = finish()
            yield links(members, members[root], turn)

    return match


def _turned(fp: Column, turn: Column) -> Column:
    """Bits turned to the left, so that another block leads."""
    whole = fp
    for bit in (1, 2, 4, 8, 16, 32):
        moved = F.shiftleft(whole, bit).bitwiseOR(F.shiftrightunsigned(whole, 64 - bit))
        whole = F.when(turn.bitwiseAND(F.lit(bit)) != 0, moved).otherwise(whole)
    return whole


def _turn_block(turn: np.ndarray, fps: np.ndarray, width: int) -> np.ndarray:
    """Number of (turn, leading block) that sorts as rows do: by turn, then by Gray rank."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return (turn.astype(np.uint64) << np.uint64(width)) | (rank >> np.uint64(64 - width))


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, group_size: int = GROUP_SIZE) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (column ``fp``) whenever a chain of neighbours does.

    Neighbours differ in ``max_bits`` bits or fewer, so of ``max_bits + 1`` blocks of bits
    they share one whole.  For each block the fingerprints are turned until it leads
    and range-sorted by Gray rank into groups of about ``group_size``: neighbours are
    then in one group, or in groups that a crowded block runs through.  Each group is
    an upper node with the bits that its members share; a fingerprint visits its own
    group and later ones that begin with its block and whose shared bits it nearly has.
    There a tree over the members is searched.  Rows grow with the fingerprints, whatever
    their number.  Within a group only links to the smallest member of a set are
    returned, so a dense cloud gives one link per fingerprint and group, not all pairs.
    """
    spark = fingerprints.sparkSession
    if max_bits < 1:
        return spark.createDataFrame([], "a long, b long")
    blocks = max_bits + 1
    width = 64 // blocks
    turns = [64 * n // blocks for n in range(blocks)]
    n = fingerprints.count()
    groups = min(MAX_GROUPS, max(1, -(-n * blocks // group_size)))
    turned = fingerprints.select("fp", F.explode(F.array(*[F.lit(t) for t in turns])).alias("turn"))
    turned = turned.select("turn", _turned(F.col("fp"), F.col("turn")).alias("fp"))
    ranked = turned.withColumn("rank", gray_rank("fp")).repartitionByRange(groups, "turn", "rank")
    # Written once: a repeated range sort could cut the groups elsewhere.
    grouped = materialized(ranked.sortWithinPartitions("turn", "rank").select("fp", "turn", F.spark_partition_id().alias("part")))
    # One row per group and turn, MAX_GROUPS and a few at most, in the order of the sort.
    nodes = grouped.groupBy("turn", "part").agg(
        F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some"), F.min(gray_rank("fp")).alias("rank"),
    ).orderBy("turn", "part").toPandas()
    if not len(nodes):
        return spark.createDataFrame([], "a long, b long")
    numbers = spark.createDataFrame(
        [(int(t), int(p), i) for i, (t, p) in enumerate(zip(nodes["turn"], nodes["part"], strict=True))], "turn int, part int, grp int")
    every, some = (nodes[c].to_numpy().view(np.uint64) for c in ("every", "some"))
    first_rank = nodes["rank"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    first_blocks = (nodes["turn"].to_numpy().astype(np.uint64) << np.uint64(width)) | (first_rank >> np.uint64(64 - width))
    visits = grouped.join(F.broadcast(numbers), ["turn", "part"]).select("grp", "fp", "turn").mapInPandas(
        _visits(first_blocks, every, ~(every ^ some), width, max_bits), "home int, guest boolean, fp long, turn int")
    dealt = visits.repartition(len(nodes), "home").sortWithinPartitions("home", "guest", gray_rank("fp"))
    return dealt.mapInPandas(_match_groups(max_bits, width), "a long, b long").where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """(key, fingerprint, component_id) of every row: SimHash and the smallest key that links reach.

    Words are cut at ASCII white space after A-Z are put in lower case; a shingle is
    ``shingle_words`` words, or all of a shorter text.  Fingerprints that differ in
    ``max_bits`` bits or fewer are linked; links are transitive.  Null, empty and
    blank texts have the fingerprint zero and are linked like any other; equal
    texts always share a component; repeated rows are all returned; a null key is
    larger than any other, so it names a component only if all its keys are null.
    An empty table gives no rows.  Other columns are ignored.

    Exact copies and equal fingerprints are one row in the search.
    """
    marked = materialized(docs.select(F.col(key).alias("k"), simhash(text, shingle_words).alias("fp")))
    distinct = materialized(marked.groupBy("fp").agg(F.min("k").alias("least")))
    members = connected_components(fingerprint_links(distinct.select("fp"), max_bits))
    linked = members.withColumnRenamed("node", "fp").join(distinct, "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("c"))
    classes = distinct.join(
        linked.select("fp", "component").join(least, "component").select("fp", "c"), "fp", "left")
    # Written, so that both sides of the last join are dealt out by fingerprint and a crowded one can be split.
    classes = materialized(classes.select("fp", F.coalesce("c", "least").alias("component_id")))
    return marked.join(classes, "fp").select(F.col("k").alias(key), as_hex("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every group of near-duplicates: the one with the smallest key.

    Rows with a null key stand behind all others and are told apart by their text, and
    so are rows that share a key.  Equal rows are one.  Null, empty and blank texts are
    near-duplicates of each other; whole texts are read, however long; an empty table gives no rows.
    Columns stay as they are, whatever their names.
    """
    name, body = "_identity", F.col(f"`{text}`")
    # The text tells rows of one key apart, so a group keeps exactly its smallest row.
    identity = F.struct(
        F.col(f"`{key}`").isNull().alias("unknown"), F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("text"),
        F.xxhash64(body, F.lit(1)).alias("more"))
    named = whole_rows(docs, F.to_json(identity).alias(name))
    found = near_duplicates(docs.select(identity.alias("k"), body.alias("text")), "k", "text", **options)
    winners = found.where("k = component_id").select(F.to_json("k").alias(name)).distinct()
    return named.join(winners, name).dropDuplicates([name]).select(f"{ROW}.*")
