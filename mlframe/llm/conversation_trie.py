"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn columns.

1. *Turns.* A turn is known by 16 bytes of the SHA-256 of its role and text,
   so texts are never shuffled. A conversation is one row: its turns' hashes
   in order and the running sum of their lengths.
2. *Blocks.* Every conversation is laid out in blocks of ``width`` columns.
   A block's rows carry the node at which the block before ended (16 bytes of
   a hash chained over the blocks), so the blocks of all depths are rolled up
   in the same pass.
3. *Nodes.* ``GROUP BY block, node, ROLLUP(t1 .. tw)`` aggregates all prefixes
   together; ``grouping_id()`` tells a row's depth in its block.
4. *Subtrees.* A node is known by its smallest member and its depth, and a
   conversation is the smallest member of the nodes from some depth e on to
   its end. With q = the characters before depth e (what it shares with an
   earlier conversation) and l = whether it heads a childless node, every
   subtree's sums are sums over members, which the same ROLLUP gives:
   leaves = sum(l), saved = sum(q) - q(smallest) - (members - 1) * characters
   before the node's own turn.
5. *Ends.* The ids that end at a node are sorted by ranges, written down in
   bounded pieces, and hashed piece after piece.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlframe.llm.tables import materialize

#: Ids in one written piece of a node's list of ends.
PIECE = 4096


def _hash(data: Column) -> Column:
    """16 bytes of the SHA-256 of binary data."""
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def _joined(first: Column, rest: Column) -> Column:
    """``first`` and all elements of ``rest`` as one binary value."""
    return F.aggregate(rest, first, lambda acc, x: F.concat(acc, x))


def _root() -> Column:
    return F.lit(bytes(16))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<h binary, n long>>) of a table of turns: each turn's hash and its text's code points, in order.

    Turns are ordered by number, null first; equal numbers by their hashes, so a
    repeated row is a further turn. Null roles and texts are empty. Rows with a
    null conversation belong to none and are left out. Other columns are
    ignored. A conversation's row holds 24 bytes a turn.
    """
    role, text = (F.encode(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), "UTF-8") for c in (role_col, text_col))
    size = F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":")), "UTF-8")
    rows = turns.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), _hash(F.concat(size, role, text)).alias("h"),
        F.coalesce(F.char_length(F.col(f"`{text_col}`")).cast("long"), F.lit(0)).alias("n"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "h", "n"))).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["h"].alias("h"), t["n"].alias("n"))).alias("turns"))


def _laid_out(convs: DataFrame, width: int) -> DataFrame:
    """One row per conversation: conv_id, size, cum (characters of the first k turns), nodes (where each block begins) and hashes."""
    none = F.array().cast("array<struct<h:binary,n:bigint>>")
    c = convs.select("conv_id", F.coalesce("turns", none).alias("turns"))
    hashes = F.transform("turns", lambda t: t["h"])
    cum = F.aggregate("turns", F.array(F.lit(0).cast("long")), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t["n"])))
    c = c.select("conv_id", F.size("turns").alias("size"), cum.alias("cum"), hashes.alias("hashes"))
    last = F.floor((F.greatest("size", F.lit(1)) - 1) / width).cast("int")
    steps = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    chain = F.aggregate(steps, F.array(_root()), lambda acc, b: F.concat(acc, F.array(
        _hash(_joined(F.element_at(acc, -1), F.slice("hashes", (b - 1) * width + 1, width))))))
    return c.withColumn("nodes", chain)


def _blocks(laid: DataFrame, width: int, *values: str) -> DataFrame:
    """One row per conversation and block: block, node, t1 .. tw (null past the end), conv_id and ``values``."""
    rows = laid.select("conv_id", *values, "hashes", F.posexplode("nodes").alias("block", "node"))
    return rows.select("block", "node", "conv_id", *values, *[F.get("hashes", F.col("block") * width + k).alias(f"t{k + 1}") for k in range(width)])


def _rolled(blocks: DataFrame, width: int, aggregates: str) -> DataFrame:
    """Every node with address, parent, depth and ``aggregates``: one ROLLUP over the blocks of all depths."""
    names = [f"t{k + 1}" for k in range(width)]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, node, {', '.join(names)}, grouping_id() AS level, {aggregates} FROM {{blocks}} "
        f"GROUP BY block, node, ROLLUP({', '.join(names)})", blocks=blocks)
    # grouping_id() has a bit for each column that a row's prefix leaves out; block and node are in every grouping
    own = F.lit(width) - F.length(F.regexp_replace(F.bin("level"), "0", ""))
    path = F.array(*names)
    at = rolled.withColumn("level", own).filter(
        F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.get(path, F.col("level") - 1).isNotNull()))
    address = F.when(F.col("level") == 0, _root()).otherwise(_hash(_joined(F.col("node"), F.slice(path, F.lit(1), F.col("level")))))
    parent = F.when(F.col("level") == 1, F.col("node")).when(F.col("level") > 1, _hash(_joined(F.col("node"), F.slice(path, F.lit(1), F.col("level") - 1))))
    return at.withColumns({"address": address, "parent": parent, "depth": (F.col("block") * width + F.col("level")).cast("long")}) \
        .drop("block", "node", "level", *names)


def _ends(laid: DataFrame, width: int) -> DataFrame:
    """(address, ends_sha256) of every node at which a conversation ends."""
    rest = F.slice("hashes", (F.size("nodes") - 1) * width + 1, width)
    address = F.when(F.col("size") == 0, _root()).otherwise(_hash(_joined(F.element_at("nodes", -1), rest)))
    ended = laid.select(address.alias("address"), "conv_id")
    order = ["address", "conv_id"]

    def write(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, PIECE):
                part = batch.slice(a, PIECE)
                nodes, ids = part.column("address").to_pylist(), part.column("conv_id").to_pylist()
                cuts = [0, *[i for i in range(1, len(nodes)) if nodes[i] != nodes[i - 1]], len(nodes)]
                spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
                yield pa.RecordBatch.from_arrays([
                    pa.array([nodes[a] for a, _ in spans], pa.binary()), pa.array([ids[a] for a, _ in spans], part.column("conv_id").type),
                    pa.array([",".join(map(str, ids[a:b])) for a, b in spans])], names=["address", "first", "ids"])

    kind = laid.schema["conv_id"].dataType.simpleString()
    pieces = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, f"address binary, first {kind}, ids string")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for address, ids in zip(batch.column("address").to_pylist(), batch.column("ids").to_pylist()):
                if address != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = address, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in ((0, pa.binary()), (1, pa.string()))],
                                             names=["address", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["address", "ends_sha256"])

    return pieces.repartition("address").sortWithinPartitions("address", "first").mapInArrow(digest, "address binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, width: int = 8) -> DataFrame:
    """One row per distinct prefix of the conversations of :func:`sequences` (null turns: none), from the textless root.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (long) and ends_sha256. conv_id must be unique and an integer. No
    conversation at all gives an empty table. The result does not depend on ``width``.
    """
    laid = materialize(_laid_out(convs, width), "conversations")
    nodes = materialize(_rolled(_blocks(laid, width), width, "min(conv_id) AS conv_id, count(*) AS n_convs"), "nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("address")).agg(F.count(F.lit(1)).alias("n_children"))
    # of each conversation: the first and last node that it heads, and whether the last one has no children
    heads = (nodes.join(children, "address", "left").groupBy("conv_id")
             .agg(F.min_by(F.struct("depth", "parent"), "depth").alias("top"), F.max_by(F.col("n_children").isNull(), "depth").alias("leaf")))
    above = nodes.select(F.col("address").alias("_up"), F.col("conv_id").alias("above"))
    heads = heads.select("conv_id", "top.depth", "top.parent", "leaf").withColumnRenamed("depth", "e")
    heads = heads.join(above, F.col("parent") == F.col("_up"), "left").select("conv_id", "e", "leaf", "above")
    known = laid.join(heads, "conv_id", "left")
    e = F.coalesce("e", F.col("size") + 1)
    shared = F.get("cum", F.greatest(e - 1, F.lit(0)).cast("int"))
    known = materialize(known.select("conv_id", "cum", "hashes", "nodes", "e", "above", shared.alias("q"),
                                     F.coalesce(F.col("leaf").cast("long"), F.lit(0)).alias("l")), "known")
    sums = _rolled(_blocks(known, width, "q", "l"), width, "sum(q) AS q_all, sum(l) AS n_leaves")
    own = known.select("conv_id", "cum", "e", "above", "q")
    rows = (nodes.join(sums.select("address", "q_all", "n_leaves"), "address").join(children, "address", "left")
            .join(_ends(laid, width), "address", "left").join(own, "conv_id"))
    before = F.get("cum", F.greatest(F.col("depth") - 1, F.lit(0)).cast("int"))
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("e"), F.col("above")).otherwise(F.col("conv_id"))
    return rows.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                       "n_leaves", (F.col("q_all") - F.col("q") - (F.col("n_convs") - 1) * before).alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
