"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits every variant within half the radius; two
fingerprints at most ``radius`` bits apart have a variant in common, and two
that share a variant are at most ``radius`` apart. So a variant's group is a
clique of at most one ball's volume, whatever the data, and linking its
members to the smallest one keeps every connection without emitting pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mlframe.llm._text import WHITE, slices, squeezed, xxh64
from mlframe.llm.components import connected_components
from mlframe.llm.tables import materialize

_LANES = np.uint64(0x0001000100010001)
_LANE_MAX = 65_535


def bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the bits that are set in over half of its hashes; ``first`` has the hashes before each text (n + 1)."""
    count = np.diff(first)
    out = np.zeros(len(count), np.uint64)
    used = np.flatnonzero(count)
    if not len(used):
        return out
    # counters are 16 bits wide, so longer texts are summed in pieces
    pieces = -(-count[used] // _LANE_MAX)
    owner = np.repeat(np.arange(len(used)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = first[used][owner] + nth * _LANE_MAX
    whole = np.cumsum(pieces) - pieces
    for j in range(16):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, at)
        for lane in range(4):
            ones = np.add.reduceat(((lanes >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64), whole)
            out[used] |= (2 * ones > count[used]).astype(np.uint64) << np.uint64(16 * lane + j)
    return out


def fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    """uint64 SimHash of each text: A-Z lowered, words between white space, XXH64 (seed 42) of space-joined shingles."""
    text, start, end, first = squeezed(column, WHITE)
    n_words = np.diff(first)
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    before = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), n)
    head = first[:-1][doc] + np.arange(before[-1]) - before[:-1][doc]
    tail = np.minimum(head + shingle, first[1:][doc]) - 1
    return bit_majority(xxh64(text, start[head], end[tail] - start[head], 42), before)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long): the unsigned 64 bits as Spark's signed long; no word gives 0."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(fingerprints_of(part.column(text_col), shingle).view(np.int64))],
                                                 names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, fingerprint long")


def ball_links(prints: DataFrame, radius: int) -> DataFrame:
    """Distinct links (a, b) that connect all fingerprints at most ``radius`` (even) bits apart.

    ``prints`` has one row per distinct fingerprint. Every variant's group is
    linked to its smallest fingerprint only; links are verified by their bit
    distance.
    """
    if radius % 2 or radius < 0:
        raise ValueError("radius must be even: half of it is the ball that each fingerprint emits")
    flips = [sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in combinations(range(64), k)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    balls = prints.select("fingerprint", F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip"))
    balls = balls.select(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("variant"), F.col("fingerprint").alias("b"))
    return (balls.withColumn("a", F.min("b").over(Window.partitionBy("variant"))).filter("b > a")
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b").distinct())


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, fingerprint long, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits, the row's own included. Null and empty texts have
    fingerprint 0 and are linked like any other. Rows are judged one by one,
    so repeated ids each get a row. A null id is never the smallest: its row
    gets the component's other ids' minimum, or null. Other columns are
    ignored; an empty table gives an empty table.
    """
    marks = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    reps = marks.groupBy("fingerprint").agg(F.min(id_col).alias("rep"))
    found = connected_components(ball_links(reps.select("fingerprint"), radius))
    class_of = F.coalesce("component", "fingerprint").alias("class")
    classes = reps.join(found, reps["fingerprint"] == found["node"], "left").select("fingerprint", "rep", class_of)
    ids = classes.groupBy("class").agg(F.min("rep").alias("component_id"))
    groups = classes.join(ids, "class").select("fingerprint", "component_id")
    return marks.join(groups, "fingerprint").select(id_col, "fingerprint", "component_id")
