"""A Merkle manifest of a dataset: a hash tree over the rows of each group, one over the groups'
roots, and for every row the proof that leads from its leaf to the root.

Nodes of a level stand side by side under their index. Siblings are found by a self-join of each
level: a node computes the index of its slot-zero sibling (one bit turned over in a binary tree,
less its slot otherwise) and is joined with that node. The slot-zero rows then hold their whole
run and emit the parents. On the way back each run hands the proof of its
parent down, extended by what stands left and right of each child, so that what all rows of a
run share is made once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.places import numbered
from barloom.llm.storage import stored, workspace

Put = Callable[[DataFrame, str], DataFrame]

#: Children of a node.
ARITY = 16


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row: each field as ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    def told(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(told, fields))


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, parent, n, children): each node at slot zero with its siblings behind it.

    Both sides are dealt by the slot-zero index, so that what a node is joined with is gathered
    without another exchange; it is less than ``arity`` rows.
    """
    slot = F.pmod("idx", F.lit(arity))
    zero = nodes.where(slot == 0).select("tree", F.col("idx").alias("head"), "n", F.col("child").alias("c0"))
    head = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot
    siblings = nodes.where(slot > 0).select("tree", head.alias("head"), F.struct(
        slot.cast("int").alias("slot"), F.col("child").alias("c")).alias("sibling"))
    runs = zero.join(siblings, ["tree", "head"], "left").groupBy("tree", "head").agg(
        F.first("n").alias("n"), F.first("c0").alias("c0"), F.collect_list("sibling").alias("later"))
    later = F.transform(F.array_sort("later", lambda a, b: a["slot"] - b["slot"]), lambda x: x["c"])
    return runs.select("tree", F.expr(f"head div {arity}").alias("parent"), "n",
                       F.concat(F.array("c0"), later).alias("children"))


def _grown(leaves: DataFrame, arity: int, put: Put) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The trees over ``leaves`` (tree, idx, n, child with a hash): the leaves that are all of
    their tree, the runs of each level, and (tree, height, hash) of each root."""
    nodes = put(leaves, "nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    lone, runs = nodes.where("n = 1"), []
    roots = lone.select("tree", F.lit(0).alias("height"), F.col("child.hash").alias("hash"))
    while most > 1:
        runs.append(put(_runs(nodes.where("n > 1"), arity), "runs"))
        most = -(-most // arity)
        nodes = runs[-1].select(
            "tree", F.col("parent").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.struct(digest(F.array_join("children.hash", "")).alias("hash")).alias("child"))
        roots = roots.unionByName(nodes.where("n = 1").select(
            "tree", F.lit(len(runs)).alias("height"), F.col("child.hash").alias("hash")))
    return lone, runs, roots


def _beside(run: Column, at: Column) -> Column:
    """What stands left and right of the child ``at`` of a run, as text."""
    hashes = run["hash"]
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
                    F.array_join(F.slice(hashes, at + 2, F.size(hashes)), "").alias("right"))


def _handed_down(lone: DataFrame, runs: list[DataFrame], tops: DataFrame, arity: int, put: Put,
                 keep: Put) -> DataFrame:
    """(child, path, and the other columns of ``tops``) for each leaf. tops has for each tree its
    height and the path above its root; a path goes upwards, a struct of what stands left and
    right for each level. What the leaves are read from is kept by run, not by leaf."""
    told = [c for c in tops.columns if c not in ("tree", "height", "above")]

    def heads(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).select(
            "tree", F.lit(0).cast("bigint").alias("parent"), "above", *told)

    leaves = keep(lone.join(heads(0), "tree").select("child", F.col("above").alias("path"), *told), "lone")
    parents = heads(len(runs))
    for k in range(len(runs) - 1, -1, -1):
        joined = runs[k].join(parents, ["tree", "parent"]).select("tree", "parent", "children", "above", *told)
        each = (put if k else keep)(joined, "proofs").select("*", F.posexplode("children").alias("at", "child"))
        path = F.concat(F.array(_beside(F.col("children"), F.col("at"))), F.col("above"))
        if k == 0:
            return leaves.unionByName(each.select("child", path.alias("path"), *told))
        parents = put(each.select("tree", (F.col("parent") * arity + F.col("at")).alias("parent"),
                                  path.alias("above"), *told), "paths").unionByName(heads(k))
    return leaves


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to over a path."""
    return F.aggregate(path, leaf, lambda h, beside: digest(beside["left"], h, beside["right"]))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda b: F.concat(b["left"], b["right"])), ""))


def manifest(docs: DataFrame, fields: Sequence[str | Column], group: str = "source", id_column: str = "doc_id",
             carry: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """(id, leaf, path, subroot, root, and the columns of ``carry``) for each row of ``docs``.

    A row's leaf is the digest of its ``fields``. The rows of a group ascend by id (null first),
    rows of one id by leaf; while a group has several nodes, each ``arity`` consecutive ones,
    at the end fewer, become the digest of their hashes. What remains is the group's subroot; the
    subroots, ordered by group (null first, then by UTF-8 bytes), give the root in the same way.
    path holds for each level from the leaf on what stands left and right of the node in its
    run, through the subroot up to the root. It is empty for a dataset of one row.

    A null group is a group like any other, and so are ids that are null. Repeated rows are
    leaves of their own, side by side, with a proof each. An empty table gives no rows. Columns
    that are not named are not read, whatever their names, but group and id columns must be
    told apart by letters other than case. ``carry`` are columns that go along with each row.
    """
    if arity < 2:
        raise ValueError("a node needs two children at least")
    carry = carry or {}
    extra = F.struct(*(c.alias(name) for name, c in carry.items())) if carry else F.lit(None).cast("string")
    with workspace() as put:
        rows = put(docs.select(
            # "-" comes before "=", so that the order of keys is the order of groups.
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("tree"),
            F.col(id_column).alias("id"),
            leaf_digest(*(F.col(f) if isinstance(f, str) else f for f in fields)).alias("hash"),
            extra.alias("extra")), "leaves")
        placed = numbered(rows, "tree", ["id", "hash"], put)
        lone, runs, subroots = _grown(placed.select(
            "tree", "idx", "n", F.struct("hash", "id", "extra").alias("child")), arity, put)
        groups = put(subroots, "subroots")
        placed = numbered(groups.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "height", "hash"),
                           "tree", ["key"], put)
        over, over_runs, root = _grown(placed.select(
            "tree", "idx", "n", F.struct("hash", "key", "height").alias("child")), arity, put)
        tops = put(_handed_down(over, over_runs, root.select(
            "tree", "height", F.col("hash").alias("root"),
            F.array().cast("array<struct<left:string,right:string>>").alias("above")), arity, put, put).select(
            F.col("child.key").alias("tree"), F.col("child.height").alias("height"),
            F.col("child.hash").alias("subroot"), "root", F.col("path").alias("above")), "tops")
        return _handed_down(lone, runs, tops, arity, put, stored).select(
            F.col("child.id").alias("id"), F.col("child.hash").alias("leaf"), "path", "subroot", "root",
            *(F.col(f"child.extra.{name}").alias(name) for name in carry))
