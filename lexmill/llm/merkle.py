"""Merkle manifest of a dataset by time-forward processing: digests go up, proofs come down."""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.ranking import ordered_ranks
from lexmill.operators.scratch import materialized

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a task sweeps at once: its subtrees have ``FANOUT ** LEVELS`` leaves at most.
LEVELS = 2


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the values in turn: ``-`` for null, else their UTF-8 byte count, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class MessageQueue:
    """Messages that wait for their receiver, which take their turn in the order of their labels."""

    def __init__(self) -> None:
        self._heap: list[tuple] = []

    def send(self, label: tuple, order: int, value) -> None:
        heapq.heappush(self._heap, (label, order, value))

    def first(self) -> tuple | None:
        return self._heap[0][0] if self._heap else None

    def receive(self) -> tuple[tuple, list]:
        """The least label and its messages in order."""
        label, values = self._heap[0][0], []
        while self._heap and self._heap[0][0] == label:
            values.append(heapq.heappop(self._heap)[2])
        return label, values


def _height(n: int, fanout: int, levels: int) -> int:
    """Levels above ``n`` nodes, ``levels`` at most."""
    height = 0
    while n > 1 and height < levels:
        n, height = -(-n // fanout), height + 1
    return height


class _Labels:
    """Nodes of a forest in post-order: (tree, last node below it, height); children stand before parents."""

    def __init__(self, fanout: int) -> None:
        self.fanout = fanout

    def of(self, tree: int, place: int, height: int, n: int) -> tuple:
        return tree, min((place + 1) * self.fanout ** height, n) - 1, height, n

    def place(self, label: tuple) -> int:
        return label[1] // self.fanout ** label[2]

    def parent(self, label: tuple) -> tuple:
        tree, _, height, n = label
        return self.of(tree, self.place(label) // self.fanout, height + 1, n)


def _sweep_up(nodes: Iterator[tuple[int, int, int, str]], fanout: int, levels: int, seen: dict | None = None) -> Iterator[tuple[int, int, int, str]]:
    """Tops (tree, place, n, digest) of the subtrees over (tree, place, n, digest) in order.

    Post-order is the order of time: a node sends its digest forward to its parent, which
    takes its turn when all children have sent.  At most ``fanout * levels`` messages
    wait at any time.  ``seen`` gets the digests that each inner node receives.
    """
    labels, queue = _Labels(fanout), MessageQueue()

    def turn(label: tuple, digest: str) -> Iterator[tuple[int, int, int, str]]:
        tree, _, height, n = label
        if height == _height(n, fanout, levels):
            yield tree, labels.place(label), -(-n // fanout ** height), digest
        else:
            queue.send(labels.parent(label), labels.place(label), digest)

    def inner() -> Iterator[tuple[int, int, int, str]]:
        label, digests = queue.receive()
        if seen is not None:
            seen[label] = digests
        yield from turn(label, _hash(digests))

    for tree, place, n, digest in nodes:
        leaf = labels.of(tree, place, 0, n)
        while queue.first() is not None and queue.first() < leaf:
            yield from inner()
        yield from turn(leaf, digest)
    while queue.first() is not None:
        yield from inner()


def _sweep_down(nodes: list[tuple[int, int, int, str]], path: tuple, fanout: int, levels: int) -> Iterator[tuple[int, tuple]]:
    """(position in ``nodes``, path) of each node of one subtree whose top has ``path``.

    Time runs backwards: parents stand before children, and a node sends each child its
    siblings, left and right of it, in front of its own path.
    """
    labels, queue, received = _Labels(fanout), MessageQueue(), {}
    for _ in _sweep_up(iter(nodes), fanout, levels, received):
        pass
    tree, start, n, _ = nodes[0]
    height = _height(n, fanout, levels)
    back = lambda label: tuple(-x for x in label)
    queue.send(back(labels.of(tree, start // fanout ** height, height, n)), 0, path)
    while queue.first() is not None:
        reverse, (path,) = queue.receive()
        label = back(reverse)
        if not label[2]:
            yield label[1] - start, path
            continue
        digests, at = received[label], labels.place(label) * fanout
        for i in range(len(digests)):
            child = labels.of(tree, at + i, label[2] - 1, n)
            queue.send(back(child), 0, ("".join(digests[:i]), "".join(digests[i + 1:]), *path))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    while chunk := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_pylist(chunk, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _tops(fanout: int, levels: int):
    schema = pa.schema([("tree", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = ((x["tree"], x["place"], x["n"], x["digest"].hex()) for x in _rows(batches))
        found = ({"tree": t, "place": p, "n": n, "digest": bytes.fromhex(d)} for t, p, n, d in _sweep_up(nodes, fanout, levels))
        yield from _batches(found, schema)

    return tops


def _delivered_paths(batches: Iterator[pa.RecordBatch], fanout: int, levels: int) -> Iterator[tuple[dict, dict, tuple]]:
    """(node, message to its subtree, its path); the message of a subtree stands before its nodes."""
    for _, rows in itertools.groupby(_rows(batches), key=lambda x: (x["tree"], x["block"])):
        message, *nodes = rows
        listed = [(x["tree"], x["place"], x["n"], x["digest"].hex()) for x in nodes]
        for i, path in _sweep_down(listed, tuple(message["path"]), fanout, levels):
            yield nodes[i], message, path


def _paths(fanout: int, levels: int):
    """Messages to the subtrees under the nodes of a level."""
    text = pa.string()
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("path", pa.list_(text)), ("subroot", text), ("root", text)])

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            {"tree": x["tree"], "block": x["place"], "path": list(path), "subroot": above["subroot"], "root": above["root"]}
            for x, above, path in _delivered_paths(batches, fanout, levels))
        yield from _batches(found, schema, 500)

    return paths


def _proofs(fanout: int, levels: int):
    """Proof, recomputed root and verdict of the leaves."""

    def fold(digest: str, path: tuple) -> str:
        for left, right in zip(path[::2], path[1::2], strict=True):
            digest = _hash((left, digest, right))
        return digest

    def proof(x: dict, above: dict, path: tuple) -> dict:
        folded = fold((x["digest"] if x["given"] is None else x["given"]).hex(), path)
        return {
            "key": x["key"], "leaf": x["digest"].hex(), "subroot": above["subroot"], "root": above["root"],
            "proof_sha256": _hash(path), "folded_root": folded, "verified": folded == above["root"]}

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        schema = pa.schema([("key", first.schema.field("key").type), *[(n, pa.string()) for n in names], ("verified", pa.bool_())])
        found = (proof(*x) for x in _delivered_paths(itertools.chain([first], batches), fanout, levels))
        yield from _batches(found, schema)

    return proofs


_NODE = "tree long, place long, n long, digest binary"
_MESSAGE = "tree long, block long, path array<string>, subroot string, root string"


def _levels_up(leaves: DataFrame, most: int, fanout: int, levels: int) -> list[DataFrame]:
    """The nodes of every ``levels``-th level; trees leave when one node is left.  ``most``: nodes of the largest tree."""
    step, tables = fanout ** levels, [leaves]
    while most > 1:
        open_trees = tables[-1].select("tree", "place", "n", "digest").where("n > 1")
        dealt = open_trees.repartition("tree", F.floor(F.col("place") / step)).sortWithinPartitions("tree", "place")
        tables.append(materialized(dealt.mapInArrow(_tops(fanout, levels), _NODE)))
        most = -(-most // step)
    return tables


def _roots(tables: list[DataFrame]) -> DataFrame:
    """(tree, level, digest) of the nodes that are alone."""
    found = [t.where("n = 1").select("tree", F.lit(i).alias("level"), "digest") for i, t in enumerate(tables)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _delivered(nodes: DataFrame, messages: DataFrame, step: int) -> DataFrame:
    """Nodes behind the message of their subtree, in the order in which a task reads them."""
    block = F.floor(F.col("place") / step).cast("long")
    # A message stands before place 0.
    above = messages.withColumn("place", F.lit(-1).cast("long")).withColumn("n", F.lit(0).cast("long"))
    both = nodes.withColumn("block", block).unionByName(above, allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _levels_down(tables: list[DataFrame], tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Messages to the subtrees of the leaves; ``tops`` are those to the roots, with their ``level``."""
    step, messages = fanout ** levels, None
    for i in range(len(tables) - 1, 0, -1):
        here = tops.where(F.col("level") == i).drop("level")
        messages = here if messages is None else messages.union(here)
        if i > 1:
            below = _delivered(tables[i - 1].where("n > 1").select("tree", "place", "n", "digest"), messages, step)
            messages = materialized(below.mapInArrow(_paths(fanout, levels), _MESSAGE))
    alone = tops.where("level = 0").drop("level")
    return alone if messages is None else messages.union(alone)


def _placed(leaves: DataFrame) -> DataFrame:
    """The leaves in order, with the number of their group, their place in it and its size."""
    ordered = materialized(
        leaves.orderBy("grp", "key", "digest", "given", "row").withColumn("pos", F.monotonically_increasing_id()))
    part = F.shiftright("pos", 33)
    # Equal groups have equal names, null too.
    named = ordered.select("key", "digest", "given", "grp", "pos", part.alias("part"), F.coalesce(F.concat(F.lit("="), F.col("grp")), F.lit("")).alias("name"))
    # One row per group and sorted partition: a group with most of the rows is spread over many.
    pieces = materialized(named.groupBy("name", "part").agg(
        F.count("*").alias("here"), F.min("pos").alias("start"), F.first("grp").alias("grp")))
    group = Window.partitionBy("name")
    upto = group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("before", F.sum("here").over(upto) - F.col("here")).withColumn("n", F.sum("here").over(group))
    # Sources in order of their bytes, null first.
    numbers = ordered_ranks(pieces.select("grp").distinct(), ["grp"], "number")
    numbers = numbers.select(F.coalesce(F.concat(F.lit("="), F.col("grp")), F.lit("")).alias("name"), (F.col("number") - 1).alias("tree"))
    known = materialized(pieces.join(numbers, "name").select("name", "part", "tree", "before", "start", "n"))
    return named.join(known, ["name", "part"]).select(
        "tree", (F.col("before") + F.col("pos") - F.col("start")).alias("place"), "n", "digest", "given", "key")


def prove(
    docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
    given: Mapping[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Each row is a leaf, see ``leaf_digest``.  The leaves of a group, by key, are hashed in runs of
    ``fanout`` (the last may be shorter), and so are the runs, until one node remains,
    the ``subroot``; the subroots in order of the group (null first, by bytes) are joined
    to ``root`` likewise.  The proof of a leaf are the digests beside its path, from
    the bottom to the root and left to right; ``proof_sha256`` is the digest of their
    texts.  ``folded_root`` is computed from the proof and the row as ``given`` has it
    (fields with other values; without them the row itself), and ``verified`` says
    whether it is ``root``.

    Time-forward processing: a node's label is its place in post-order.  Digests are
    messages to the parent's label; sorted by label they are the external queue,
    written as a table between rounds, dealt out by subtrees of ``fanout ** levels`` nodes, and swept in
    order within a task, where few messages wait.  Reversed sweeps then carry the
    proofs' upper parts down in the same way.  Only digests move, no texts, and
    a group with most of the rows is as many subtrees as it needs.

    Null keys come first, equal keys are ordered by their digests; repeated rows are
    leaves of their own; null and empty fields differ; texts of any length are hashed
    whole; an empty table gives no rows; other columns are ignored.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    leaf, other = leaf_digest(list(values.values())), leaf_digest(list((values | dict(given or {})).values()))
    marked = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").cast("string").alias("grp"), F.unhex(leaf).alias("digest"),
        F.unhex(other).alias("given") if given else F.lit(None).cast("binary").alias("given"), F.monotonically_increasing_id().alias("row"))
    # Leaves that are as they were need no second digest.
    leaves = materialized(marked.withColumn("given", F.when(F.col("given") != F.col("digest"), F.col("given"))))
    nodes = _placed(leaves)
    sizes = nodes.agg(F.max("n").alias("n"), (F.max("tree") + 1).alias("trees")).first()
    tables = _levels_up(nodes, sizes["n"] or 0, fanout, levels)
    subroots = materialized(_roots(tables))
    forest = _levels_up(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(sizes["trees"] or 0).cast("long").alias("n"), "digest"),
        sizes["trees"] or 0, fanout, levels)
    root = _roots(forest).withColumn("root", F.lower(F.hex("digest")))
    empty = F.array().cast("array<string>")
    down = _levels_down(forest, root.select(
        "tree", F.lit(0).cast("long").alias("block"), empty.alias("path"), F.lit("").alias("subroot"), "root", "level"), fanout, levels)
    # Every subroot is a leaf of the upper tree.
    above = _delivered(forest[0], down, fanout ** levels).mapInArrow(_paths(fanout, levels), _MESSAGE)
    tops = above.select(F.col("block").alias("tree"), "path", "root").join(subroots, "tree").select(
        "tree", F.lit(0).cast("long").alias("block"), "path", F.lower(F.hex("digest")).alias("subroot"), "root", "level")
    messages = _levels_down(tables, materialized(tops), fanout, levels)
    kind = dict(nodes.dtypes)["key"]
    done = _delivered(nodes, messages, fanout ** levels).mapInArrow(
        _proofs(fanout, levels),
        f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return done.withColumnRenamed("key", key)


def lower_case_tampering(key: Column | str, text: Column | str) -> dict[str, Column]:
    """The contract's tampering: A-Z of the text in lower case where 5 divides the CRC-32 of the key."""
    key, text = (F.col(c) if isinstance(c, str) else c for c in (key, text))
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(F.crc32(key.cast("string").cast("binary")) % 5 == 0, lower).otherwise(text)}
