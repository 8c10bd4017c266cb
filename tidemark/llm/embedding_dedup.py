"""Near-duplicate vectors by tiles of int8 products, rigorous error bounds and exact recomputation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import classes, discard, written

TILE = 2048  # vectors in a block; a task multiplies two blocks
EXACT_ROWS = 65_536  # pairs recomputed at once


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, int8 codes, scale, error) of float64 rows: unit = scale * code + rest, |rest| <= error."""
    unit = rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    scale = np.abs(unit).max(axis=1) / 127.0
    code = np.rint(unit / scale[:, None])
    rest = unit - scale[:, None] * code
    # a little more than measured, for the rounding of this computation itself
    error = np.sqrt(np.einsum("ij,ij->i", rest, rest)) * (1 + 1e-9) + 1e-12
    return unit, code.astype(np.int8), scale, error


def possible(a, b, threshold: float) -> np.ndarray:
    """Mask of pairs whose cosine may reach ``threshold``.

    With u = s p + e and v = t q + f, u.v = s t p.q + e.v + s p.f, so |u.v - s t p.q| <= |e| + (1 + |e|) |f| as |v| = 1 and
    |s p| <= 1 + |e|. Integer products of codes are exact in float32 below 2**24, else in float64.
    """
    (_, p, s, e), (_, q, t, f) = a, b
    kind = np.float32 if p.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = p.astype(kind) @ q.astype(kind).T
    value = product.astype(np.float64)
    value *= s[:, None]
    value *= t[None, :]
    value += e[:, None]
    value += (1 + e)[:, None] * f[None, :]
    return value >= threshold


def links(a_rows: np.ndarray, b_rows: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of pairs with cosine >= threshold in double precision; i < j where both sides are one block."""
    a = quantise(a_rows)
    b = a if same else quantise(b_rows)
    i, j = np.nonzero(possible(a, b, threshold))
    if same:
        i, j = i[i < j], j[i < j]
    a_norm = np.sqrt(np.einsum("ij,ij->i", a_rows, a_rows))
    b_norm = np.sqrt(np.einsum("ij,ij->i", b_rows, b_rows))
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), EXACT_ROWS):
        x, y = i[at:at + EXACT_ROWS], j[at:at + EXACT_ROWS]
        keep[at:at + EXACT_ROWS] = np.einsum("ij,ij->i", a_rows[x], b_rows[y]) / (a_norm[x] * b_norm[y]) >= threshold
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Least name of each position's class under the links (i, j)."""
    root = name.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    return root


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """One row per vector: ``id``, n_links, component_id, kept.

    Two vectors link when they have the same label and as many components and their cosine is at least ``threshold`` > 0. Rows whose
    label, vector or id is null, whose vector is empty, zero or holds a null or non-finite component link with nothing:
    0 links, their own id as component, kept. Ids are unique integers; equal vectors (repeated rows too) are compared once and counted.
    Components may be as large or small as doubles are.

    A label's distinct vectors are dealt by hash into blocks of about ``tile``; every two blocks of a label meet in one task, which
    returns per vector its number of links and the least id it is connected to there, so a dense group
    costs rows in proportion to its vectors. A label of n vectors needs about (n / tile)**2 / 2 tasks, which is the method's price.
    """
    kinds = dict(vectors.dtypes)
    rows = vectors.select(vectors[id].alias("id"), vectors[vector].cast("array<double>").alias("v"), vectors[label].alias("label"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    # a power of two near the largest component changes no angle and keeps squares far from both ends of the doubles
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    rows = rows.withColumn("_by", F.when(F.col("ok"), F.pow(F.lit(2.0), F.floor(F.log2(largest)))))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x / F.col("_by")))).drop("_by")
    rows = written(rows.withColumn("k1", F.when(F.col("ok"), F.xxhash64("label", "v")))
                   .withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit(7), "v", "label"))), "vectors")
    distinct = (rows.where("ok").groupBy("k1", "k2")
                .agg(F.min("id").alias("node"), F.count("*").alias("w"), F.first("label").alias("label"), F.first("v").alias("v")))
    distinct = written(distinct.withColumn("d", F.size("v")), "distinct")
    counts = distinct.groupBy("label", "d").agg(F.count("*").alias("n"))
    counts = counts.select("label", "d", F.ceil(F.col("n") / tile).cast("int").alias("blocks"))
    packed = distinct.join(counts, ["label", "d"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    def join_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch["members"].to_pylist()
            out = [np.array([m["v"] for m in r], np.float64).tobytes() for r in members]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], batch["d"], batch["blocks"], batch["block"],
                 pa.array([[m["node"] for m in r] for r in members], pa.list_(pa.int64())),
                 pa.array([[m["w"] for m in r] for r in members], pa.list_(pa.int64())),
                 pa.array(out, pa.binary())], names=["label", "d", "blocks", "block", "nodes", "weights", "matrix"])

    # a block is bounded: its label's vectors are dealt evenly over as many blocks as `tile` asks for
    gathered = packed.groupBy("label", "d", "blocks", "block").agg(F.collect_list(F.struct("node", "w", "v")).alias("members"))
    blocks = written(gathered.mapInArrow(
        join_rows, f"label {kinds[label]}, d int, blocks int, block int, nodes array<long>, weights array<long>, matrix binary"), "blocks")
    one = blocks.select("label", "d", "blocks", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"),
                        F.col("nodes").alias("a_nodes"), F.col("weights").alias("a_weights"), F.col("matrix").alias("a"))
    two = blocks.select("label", "d", F.col("block").alias("j"), F.col("nodes").alias("b_nodes"), F.col("weights").alias("b_weights"),
                        F.col("matrix").alias("b"))
    tiles = one.join(two, ["label", "d", "j"]).select("d", "i", "j", "a_nodes", "a_weights", "a", "b_nodes", "b_weights", "b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                a = np.frombuffer(r["a"], np.float64).reshape(-1, r["d"])
                b = np.frombuffer(r["b"], np.float64).reshape(-1, r["d"])
                same = r["i"] == r["j"]
                x, y = links(a, b, threshold, same)
                nodes, weights = np.array(r["a_nodes"]), np.array(r["a_weights"])
                if not same:
                    y = y + len(nodes)
                    nodes = np.concatenate([nodes, np.array(r["b_nodes"])])
                    weights = np.concatenate([weights, np.array(r["b_weights"])])
                total = np.zeros(len(nodes), np.int64)
                np.add.at(total, x, weights[y])
                np.add.at(total, y, weights[x])
                root = _roots(len(nodes), x, y, nodes)
                hit = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[hit]), pa.array(total[hit]), pa.array(root[hit])], names=["node", "n", "root"])

    found = written(tiles.mapInArrow(compared, "node long, n long, root long"), "tiles")
    numbers = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = classes(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-classes")
    per_node = (distinct.select("k1", "k2", "node", "w").join(numbers, "node", "left").join(roots, "node", "left")
                .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                        F.coalesce("root", "node").alias("root")))
    result = written(
        rows.select("id", "k1", "k2").join(per_node, ["k1", "k2"], "left")
        .select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("root", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True))), "near-vectors")
    discard(rows, distinct, blocks, found)
    return result
