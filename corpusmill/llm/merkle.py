"""Merkle manifest of a dataset, by time-forward processing.

Every tree is cut into blocks of ``arity ** levels`` consecutive nodes. In a
block the nodes have labels in the order in which they can be computed: by the
last leaf below them, then by level. A priority queue ordered by label holds
the messages on their way: a node reads its children's digests from it and
sends its own on to its parent, so only the path at hand is waiting. The outer
part of the queue is Spark's sorted shuffle, which spills to disk: the top
nodes of all blocks are messages to the next round of blocks, until each tree
has one node. The subtrees' roots are then the leaves of one more tree.

On the way back blocks are met from the root down. Each one gets the proof of
its top node, walks its labels in reverse, and hands every child the proof of
its parent behind the child's own siblings, down to the leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.runtime import materialise


@dataclass(frozen=True)
class Shape:
    """``arity`` children at most per node; a block has ``levels`` levels above its lowest nodes."""

    arity: int = 16
    levels: int = 3

    @property
    def block(self) -> int:
        return self.arity ** self.levels


#: The columns of ``documents`` that a leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A node of tree ``tree``: its place among the ``size`` nodes of its level there.
_NODES = "tree string, place long, size long, digest string"
#: Levels of a proof from the lowest: the digests of the run the node is in, and where it stands.
_PROOF = "array<struct<run:array<string>,at:int>>"
_PROOF_TYPE = pa.list_(pa.struct([("run", pa.list_(pa.string())), ("at", pa.int32())]))


def joined_hash(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


# One block of nodes

def rise(digests: list[str], levels: int, arity: int, last_round: bool) -> list[list[str]]:
    """The nodes of a block by level, from the lowest to the top.

    With ``last_round`` the block is all that is left of its tree, and levels
    end at a single node.
    """
    made: list[list[str]] = [digests]
    count = [len(digests)]
    while len(count) <= levels and not (last_round and count[-1] == 1):
        count.append(-(-count[-1] // arity))
        made.append([])
    if len(count) == 1:
        return made
    queue: list[tuple[int, int, int, str]] = []  # (last leaf, level, place of the child, digest): label of the receiver

    def send(level: int, place: int, digest: str) -> None:
        parent = place // arity
        last = min((parent + 1) * arity ** (level + 1), len(digests)) - 1
        heapq.heappush(queue, (last, level + 1, place, digest))

    for leaf, digest in enumerate(digests):
        send(0, leaf, digest)
        while queue and queue[0][0] == leaf:
            _, level, place, first = heapq.heappop(queue)
            run = [first]
            while queue and queue[0][:2] == (leaf, level):
                run.append(heapq.heappop(queue)[3])
            own = joined_hash(run)
            made[level].append(own)
            if level + 1 < len(count):
                send(level, place // arity, own)
    return made


def fall(made: list[list[str]], arity: int, top) -> list:
    """The proofs of a block's lowest nodes, given its top node's; a proof is ``(run, place in it, rest)`` or none.

    Runs and rests are shared between proofs, so a block's proofs take the
    memory of its nodes.
    """
    height = len(made) - 1
    if not height:
        return [top]
    # Reversed labels: the last nodes first, and a parent before its children.
    queue = [(1 - len(made[0]), -height, 0, top)]
    out: list = [None] * len(made[0])
    while queue:
        _, level, place, proof = heapq.heappop(queue)
        below = made[-level - 1][place * arity:(place + 1) * arity]
        for at in range(len(below)):
            own, child = (below, at, proof), place * arity + at
            if level == -1:
                out[child] = own
            else:
                last = min((child + 1) * arity ** (-level - 1), len(made[0])) - 1
                heapq.heappush(queue, (-last, level + 1, child, own))
    return out


def listed(proof) -> list[dict]:
    """A proof from the lowest level up."""
    out = []
    while proof is not None:
        out.append({"run": proof[0], "at": proof[1]})
        proof = proof[2]
    return out


def linked(levels: list[dict] | None):
    """The reverse of ``listed``."""
    proof = None
    for level in reversed(levels or []):
        proof = (level["run"], level["at"], proof)
    return proof


def siblings(proof) -> Iterator[str]:
    """The digests beside a node's path, level by level, left to right."""
    while proof is not None:
        run, at, proof = proof
        yield from run[:at]
        yield from run[at + 1:]


def folded(digest: str, proof) -> str:
    """The root that a leaf and its proof lead to."""
    while proof is not None:
        run, at, proof = proof
        digest = joined_hash([*run[:at], digest, *run[at + 1:]])
    return digest


# Blocks in a sorted stream

def _blocks(batches, p: Shape, extra: list[str]) -> Iterator[tuple]:
    """``(tree, block, rows)`` of rows that are sorted by tree, block and place; ``rows`` are lists by column."""
    key, rows = None, None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("tree", "place", "size", "digest", *extra)]
        for row in zip(*columns, strict=True):
            block = -1 if row[1] is None else row[1] // p.block
            own = (row[0], block)
            if own != key:
                if rows:
                    yield (*key, rows)
                key, rows = own, []
            rows.append(row)
    if rows:
        yield (*key, rows)


def _dealt(nodes: DataFrame, p: Shape) -> DataFrame:
    """Blocks of nodes, each whole in one partition and in order."""
    block = F.floor(F.col("place") / p.block)
    return nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _tops(batches, p: Shape) -> Iterator[pa.RecordBatch]:
    for tree, block, rows in _blocks(batches, p, []):
        size = rows[0][2]
        top = rise([r[3] for r in rows], p.levels, p.arity, size <= p.block)[-1][0]
        yield pa.RecordBatch.from_arrays([
            pa.array([tree], pa.string()), pa.array([block], pa.int64()), pa.array([-(-size // p.block)], pa.int64()),
            pa.array([top])], names=["tree", "place", "size", "digest"])


def roots(nodes: DataFrame, p: Shape = Shape()) -> list[DataFrame]:
    """Rounds of nodes: the given ones, the tops of their blocks and so on; the last has one node per tree."""
    rounds = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        tops = _dealt(rounds[-1].select("tree", "place", "size", "digest"), p).mapInArrow(lambda b: _tops(b, p), _NODES)
        rounds.append(materialise(tops, "merkle-round"))
        largest = -(-largest // p.block)
    return rounds


def _proofs_of(batches, p: Shape, extra: list[str], rows_of) -> Iterator[pa.RecordBatch]:
    """Blocks whose first row is the proof of their top node."""
    for _, _, rows in _blocks(batches, p, [*extra, "proof"]):
        head, rows = rows[0], rows[1:]
        if not rows:
            continue
        made = rise([r[3] for r in rows], p.levels, p.arity, rows[0][2] <= p.block)
        yield from rows_of(rows, fall(made, p.arity, linked(head[-1])), head)


def _met(nodes: DataFrame, above: DataFrame, p: Shape) -> DataFrame:
    """Nodes with, before each block, the row ``(tree, place = block)`` of ``above`` that has its top's proof."""
    low = nodes.withColumns({"block": F.floor(F.col("place") / p.block), "lower": F.lit(1), "proof": F.lit(None).cast(_PROOF)})
    high = above.select("tree", (F.col("place") * p.block).alias("place"), F.col("place").alias("block"), F.lit(0).alias("lower"), "proof",
                        *[c for c in ("subroot",) if c in above.columns])
    both = low.unionByName(high, allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "lower", "place")


def _passed_down(rows: list, proofs: list, head: tuple) -> Iterator[pa.RecordBatch]:
    """Proofs of the nodes of one block, for the next round."""
    step = 256
    for i in range(0, len(rows), step):
        part = rows[i:i + step]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.int64()),
            pa.array([listed(q) for q in proofs[i:i + step]], _PROOF_TYPE), pa.array([head[4]] * len(part), pa.string())],
            names=["tree", "place", "proof", "subroot"])


def proofs_above(rounds: list[DataFrame], tops: DataFrame, p: Shape) -> DataFrame:
    """``(tree, place, proof, subroot)`` for the blocks of the lowest round, given the proofs of the trees' roots."""
    for nodes in reversed(rounds[1:-1]):
        rows = _met(nodes.select("tree", "place", "size", "digest"), tops, p)
        tops = materialise(rows.mapInArrow(lambda b: _proofs_of(b, p, ["subroot"], _passed_down),
                                           f"tree string, place long, proof {_PROOF}, subroot string"), "merkle-proofs")
    return tops


# Documents

def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: per value ``-`` if null, else its bytes, a colon and itself."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def leaves(docs: DataFrame, *, tamper: Column | None = None) -> DataFrame:
    """``(doc_id, tree, digest, tampered)``: a leaf per row, and its digest after tampering where that applies.

    The tree is the source after a mark, so that no source looks like a missing one.
    """
    values = [F.col(c) for c in FIELDS]
    changed = leaf_digest([*values[:-1], lower_ascii(values[-1])])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")).alias("tree"),
                       leaf_digest(values).alias("digest"),
                       F.when(F.lit(False) if tamper is None else tamper, changed).alias("tampered"))


def with_places(rows: DataFrame, order: list[str], *, by: str = "tree") -> DataFrame:
    """Add ``place`` and ``size`` of every row among those of its tree, in the order of ``order`` (nulls first).

    The rows are dealt out by ranges and written with the number of their
    range; places are those within the range plus the rows of ranges before.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(rows.repartitionByRange(n, by, *order).withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = dealt.groupBy(by, "part").agg(F.count("*").alias("rows"))
    tree = Window.partitionBy(by)
    # A tree has as many rows here as ranges it runs over.
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(by, "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(tree).alias("size"))
    inside = dealt.withColumn("at", F.row_number().over(Window.partitionBy(by, "part").orderBy(*order)) - 1)
    return (inside.join(counts, [by, "part"]).withColumn("place", (F.col("before") + F.col("at")).cast("long"))
            .drop("part", "before", "at"))


MANIFEST = ("doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean")


def _manifest_rows(root: str, keep_proof: bool):
    def rows_of(rows: list, proofs: list, head: tuple) -> Iterator[pa.RecordBatch]:
        step = 1024
        for i in range(0, len(rows), step):
            part, own = rows[i:i + step], proofs[i:i + step]
            back = [folded(r[6] or r[3], q) for r, q in zip(part, own, strict=True)]
            columns = [
                pa.array([r[5] for r in part], pa.int64()), pa.array([r[0][1:] if r[0] else None for r in part], pa.string()),
                pa.array([r[3] for r in part]), pa.array([head[4]] * len(part)), pa.array([root] * len(part)),
                pa.array([joined_hash(list(siblings(q))) for q in own]), pa.array(back), pa.array([b == root for b in back])]
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            if keep_proof:
                columns.append(pa.array([listed(q) for q in own], _PROOF_TYPE))
                names.append("proof")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return rows_of


def manifest(docs: DataFrame, p: Shape = Shape(), *, tamper: Column | None = None, keep_proof: bool = False) -> DataFrame:
    """The leaf of every row, its proof up to the root, and the root that leaf and proof lead to; see ``MANIFEST``.

    Per source the rows ascend by doc_id, null ids first, equal ones by their
    leaf, so repeated rows stand side by side with leaves of their own. Rows
    without a source are a tree of their own, the first. Where ``tamper`` holds
    the proof is tried on the row with its text in lower case. An empty table
    gives no rows. Columns other than ``FIELDS`` are not covered. A text of any
    length is hashed whole. With ``keep_proof`` the proofs themselves are
    returned, level by level with the run and the place in it.
    """
    small_batches(docs.sparkSession)
    # Written before ranges are sampled, so texts are hashed once.
    hashed = materialise(leaves(docs, tamper=tamper), "merkle-digests")
    placed = materialise(with_places(hashed, ["doc_id", "digest"]), "merkle-leaves")
    rounds = roots(placed, p)
    # Sources are few or many; their subroots are one tree of the same kind.
    subroots = with_places(rounds[-1].select(F.lit("").alias("all"), "tree", F.col("digest")), ["tree"], by="all")
    upper = materialise(subroots.select(F.col("all").alias("tree"), F.col("tree").alias("own"), "place", "size", "digest"),
                        "merkle-subroots")
    upper_rounds = roots(upper, p)
    top = upper_rounds[-1].select("digest").first()
    if top is None:
        return docs.sparkSession.createDataFrame([], MANIFEST + (f", proof {_PROOF}" if keep_proof else ""))
    root = top["digest"]
    start = upper_rounds[-1].select("tree", "place", F.array().cast(_PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"))
    start = proofs_above(upper_rounds, start, p)
    sources = _met(upper, start, p).mapInArrow(
        lambda b: _proofs_of(b, p, ["subroot", "own"], _source_rows), f"tree string, place long, proof {_PROOF}, subroot string")
    tops = proofs_above(rounds, materialise(sources, "merkle-tops"), p)
    schema = MANIFEST + (f", proof {_PROOF}" if keep_proof else "")
    rows_of = _manifest_rows(root, keep_proof)
    return _met(placed, tops, p).mapInArrow(lambda b: _proofs_of(b, p, ["subroot", "doc_id", "tampered"], rows_of), schema)


def _source_rows(rows: list, proofs: list, head: tuple) -> Iterator[pa.RecordBatch]:
    """The subroots' proofs, as the top rows of the sources' trees."""
    yield pa.RecordBatch.from_arrays([
        pa.array([r[5] for r in rows], pa.string()), pa.array([0] * len(rows), pa.int64()),
        pa.array([listed(q) for q in proofs], _PROOF_TYPE), pa.array([r[3] for r in rows], pa.string())],
        names=["tree", "place", "proof", "subroot"])
