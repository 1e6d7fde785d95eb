"""Merkle manifest of a dataset by time-forward processing.

Nodes carry labels (tree, level, place) that put children before parents. Forward, every node sends its digest
to its parent; the parent is due when the queue, ordered by label, hands out its messages. Backward, every
node sends the *proof suffix* of its children: the siblings on the way from it to the root.

The queue between tasks is Spark's shuffle with its external sort: messages are dealt by the label of the subtree they
go to and handed out in label order, so memory holds one subtree's messages and nothing is kept by a task
that could get lost. A subtree spans ``SPAN`` levels, that is 3^SPAN nodes at its foot, however large its tree is: a
source with a third of all rows is many subtrees. One forward round takes SPAN levels, so 10^10 rows of one source need five
rounds; the subroots of all sources are the leaves of one more tree of the same kind. Each round's table has a 243rd of the
rows of the one before.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import stored

#: Children of a node, and levels of a subtree that one task folds at a time.
ARITY, SPAN = 3, 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of length-prefixed values: ``-`` for null, else bytes in UTF-8, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def levels(nodes: int) -> int:
    """Levels above ``nodes`` leaves until one node is left."""
    count = 0
    while nodes > 1:
        nodes, count = -(-nodes // ARITY), count + 1
    return count


def _digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _fold(digests: list[str], height: int) -> list[list[str]]:
    """All levels of a subtree, its foot first: a queue ordered by (level, place) hands children to their parent."""
    queue = [(0, i, d) for i, d in enumerate(digests)]  # already in label order
    rows = []
    for level in range(height + 1):
        row = []
        while queue and queue[0][0] == level:
            row.append(heapq.heappop(queue)[2])
        rows.append(row)
        if level < height:
            for place in range(0, len(row), ARITY):
                heapq.heappush(queue, (level + 1, place // ARITY, _digest(row[place:place + ARITY])))
    return rows


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, members in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield key, list(members)


def _height(nodes: int) -> int:
    return min(SPAN, levels(nodes))


_UP = "tree string, place long, nodes long, digest string"


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []

    def batch() -> pa.RecordBatch:
        trees, places, nodes, digests = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(places, pa.int64()), pa.array(nodes, pa.int64()),
                                           pa.array(digests, pa.string())], ["tree", "place", "nodes", "digest"])

    for (tree, block), members in _subtrees(batches):
        nodes = members[0]["nodes"]
        height = _height(nodes)
        out.append((tree, block, -(-nodes // ARITY ** height), _fold([m["digest"] for m in members], height)[-1][0]))
        if len(out) >= 10_000:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, kinds = [], {}

    def seen() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds.setdefault("payload", batch.schema.field("payload").type)
            yield batch

    def batch() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), kinds["payload"], pa.list_(pa.string()), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)],
                                          ["tree", "place", "digest", "payload", "proof", "subroot", "root"])

    for (tree, _), members in _subtrees(seen()):
        message, members = members[0], members[1:]  # the subtree root's suffix comes before the nodes at its foot
        rows = _fold([m["digest"] for m in members], _height(members[0]["nodes"]))
        suffixes = [message["proof"]]
        for row in reversed(rows[:-1]):
            below = []
            for place in range(len(row)):
                first = place - place % ARITY
                siblings = row[first:first + ARITY]
                siblings[place - first] = "*"
                below.append(["".join(siblings), *suffixes[place // ARITY]])
            suffixes = below
        out += [(tree, m["place"], m["digest"], m["payload"], suffix, message["subroot"], message["root"]) for m, suffix in zip(members, suffixes)]
        if len(out) >= 2_000:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _blocked(nodes: DataFrame) -> DataFrame:
    """Nodes with the number of the subtree at whose foot they are; a tree of few nodes is one lower subtree."""
    foot = F.lit(1)
    for k in range(1, SPAN + 1):
        foot = F.when(F.col("nodes") > ARITY ** (k - 1), ARITY ** k).otherwise(foot)
    return nodes.withColumn("block", F.floor(F.col("place") / foot).cast("long"))


def _dealt(messages: DataFrame) -> DataFrame:
    return messages.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _sweep_up(nodes: DataFrame) -> DataFrame:
    return _dealt(_blocked(nodes).select("tree", "block", "place", "nodes", "digest")).mapInArrow(_forward, _UP)


def _sweep_down(nodes: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``suffixes``: tree, place (of a subtree's root), proof, subroot, root. One message a subtree, sorted before its nodes."""
    if "payload" not in nodes.columns:
        nodes = nodes.withColumn("payload", F.lit(None).cast("int"))
    messages = suffixes.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "proof", "subroot", "root")
    both = _blocked(nodes).unionByName(messages, allowMissingColumns=True)
    kind = nodes.schema["payload"].dataType.simpleString()
    return _dealt(both.select("tree", "block", "place", "nodes", "digest", "payload", "proof", "subroot", "root")).mapInArrow(
        _backward, f"tree string, place long, digest string, payload {kind}, proof array<string>, subroot string, root string")


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Stored rows with ``place`` (from 0, by ``order`` in each tree) and ``nodes`` (rows of the tree).

    Rows are dealt by ranges, so a large tree is spread over many tasks; complete copies of a row are spread by the
    position at which they were stored. A tree's rows in a task have consecutive numbers; one row for each task and tree gives
    their offsets.
    """
    rows = rows.withColumn("_copy", F.monotonically_increasing_id())
    keys = [tree, *order, "_copy"]
    at = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_copy")
                .withColumns({"shard": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "numbered")
    parts = at.groupBy(tree, "shard").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(tree)
    offsets = parts.select(tree, "shard", "first", (F.sum("n").over(whole.orderBy("shard")) - F.col("n")).alias("offset"),
                           F.sum("n").over(whole).alias("nodes"))
    return stored(at.join(offsets, [tree, "shard"]).withColumn("place", F.col("at") - F.col("first") + F.col("offset")).drop("shard", "at", "first", "offset"),
                  "placed")


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """One node a tree from ``nodes`` (tree, place, nodes, digest), and the input of each round."""
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    rounds = []
    while True:
        rounds.append(nodes)
        nodes = stored(_sweep_up(nodes), "forward")
        most = -(-most // ARITY ** SPAN)
        if most <= 1:
            return nodes, rounds


def _descend(rounds: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    for nodes in reversed(rounds):
        suffixes = _sweep_down(nodes, suffixes)
    return suffixes


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", source: str = "source",
                    also: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, place, leaf, proof, subroot, root, and the columns named in ``also``.

    A leaf is the digest of the named fields. Leaves of one source ascend by key (null first); rows of one key ascend by
    leaf, so repeated rows are leaves of their own. While several nodes remain, every three consecutive ones (the last
    run may be shorter, even one) become the digest of their concatenation; subroots, ordered by source (null first, then by
    bytes), become the root in the same way. ``proof`` has one text a level from the leaf up: the digests of a run,
    ``*`` in place of the node itself, so ``folded`` gives the root back. Empty texts differ from null ones; texts of any
    length are read whole, once. An empty table gives no row. Columns not named are not read, so none can clash.
    """
    column = {f: F.col(f"`{f}`") for f in {*fields, key, source}}
    extra = also or {}
    # a null source sorts first and differs from an empty one
    tree = F.coalesce(F.concat(F.lit("="), column[source].cast("string")), F.lit(""))
    payload = F.struct(column[key].alias("doc_id"), column[source].alias("source"), *(c.alias(f"also_{name}") for name, c in extra.items()))
    leaves = stored(docs.select(tree.alias("tree"), leaf_digest([column[f] for f in fields]).alias("digest"), payload.alias("payload")), "leaves")
    placed = numbered(leaves, "tree", ["payload.doc_id", "digest"])
    subroots, rounds = _climb(placed.select("tree", "place", "nodes", "digest"))
    # the top tree has a leaf for each source, in the order of sources
    top = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest"), "tree", ["source_tree"])
    peak, top_rounds = _climb(top.select("tree", "place", "nodes", "digest"))
    summit = peak.select("tree", "place", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    down = _descend(top_rounds, summit).select("place", "proof", "root")
    suffixes = stored(top.select("place", "source_tree", "digest").join(down, "place")
                      .select(F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("place"), "proof", F.col("digest").alias("subroot"), "root"), "suffixes")
    proofs = _descend([placed, *rounds[1:]], suffixes)
    return proofs.select("payload.doc_id", "payload.source", "place", F.col("digest").alias("leaf"), "proof", "subroot", "root",
                         *(F.col("payload")[f"also_{name}"].alias(name) for name in extra))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""
    return F.aggregate(proof, leaf, lambda node, siblings: F.sha2(F.replace(siblings, F.lit("*"), node).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.replace(F.array_join(proof, ""), F.lit("*"), F.lit("")).cast("binary"), 256)
