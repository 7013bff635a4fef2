"""Embedding near-duplicates with iterative quantisation.

A rotation learnt on a bounded sample makes the signs of centred, normalised
vectors balanced binary codes. Codes are looked up in several Hamming tables,
one per 16-bit part, with every part also probed one bit away. A pair is kept
at the first table in which it meets, so no table repeats another's pairs, and
is reranked by the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import stash
from hebdo.llm.components import connected_components


@dataclass(frozen=True)
class ItqParams:
    cosine: float = 0.95
    sample: int = 20_000      # vectors that the rotation is learnt on, at most
    rounds: int = 40
    parts: int = 8            # Hamming tables of 16 bits
    seed: int = 3


def learn(sample: np.ndarray, params: ItqParams) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal directions turned so that rounding to signs loses least.
    With more bits than dimensions further rotations are learnt from other starts."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    # about the mean of a few vectors, near ones lie on opposite sides
    mean = x.mean(axis=0) if len(x) >= 16 * params.parts else np.zeros(x.shape[1])
    x = x - mean
    _, vectors = np.linalg.eigh(x.T @ x)
    bits, rng, out = 16 * params.parts, np.random.default_rng(params.seed), []
    while sum(p.shape[1] for p in out) < bits:
        width = min(x.shape[1], bits - sum(p.shape[1] for p in out))
        basis = vectors[:, ::-1][:, :width]
        v = x @ basis
        r, _ = np.linalg.qr(rng.standard_normal((width, width)))
        for _ in range(params.rounds):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(basis @ r)
    return mean, np.concatenate(out, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _codes(vectors: DataFrame, mean: np.ndarray, projection: np.ndarray, parts: int) -> DataFrame:
    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            x = _matrix(rb.column("v"))
            x = x / np.linalg.norm(x, axis=1, keepdims=True) - mean
            words = np.packbits(x @ projection >= 0, axis=1).view(np.uint16).astype(np.int32)
            code = pa.ListArray.from_arrays(np.arange(0, len(x) + 1, dtype=np.int32) * parts, pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays([rb.column("id"), code], names=["id", "code"])

    return vectors.select("id", "v").mapInArrow(run, "id long, code array<int>")


def _apart(i: int) -> Column:
    return F.bit_count(F.col("x.code")[i].bitwiseXOR(F.col("y.code")[i]))


def _near_pairs(codes: DataFrame, parts: int) -> DataFrame:
    tables = F.posexplode("code")
    index = codes.select("id", "code", tables.alias("table", "part"))
    flips = F.array(F.lit(0), *(F.lit(1 << b) for b in range(16)))
    probe = index.select("id", "code", "table", F.explode(F.transform(flips, lambda m: F.col("part").bitwiseXOR(m))).alias("part"))
    first = F.lit(True)
    for i in range(parts):
        first = first & ((F.lit(i) >= F.col("x.table")) | (_apart(i) > 1))
    on = (F.col("x.table") == F.col("y.table")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.id") < F.col("y.id")) & first
    return probe.alias("x").join(index.alias("y"), on).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _rerank(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            x, y = _matrix(rb.column("va")), _matrix(rb.column("vb"))
            cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
            keep = pa.array(cos >= cosine)
            yield rb.select(["a", "b"]).append_column("cosine", pa.array(cos)).filter(keep)

    one = vectors.select(F.col("id").alias("a"), F.col("v").alias("va"))
    two = vectors.select(F.col("id").alias("b"), F.col("v").alias("vb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long, cosine double")


def _links(classes: DataFrame, params: ItqParams) -> DataFrame:
    """(a, b, cosine) of near vectors among those of one length."""
    some = classes.orderBy(F.xxhash64("id"), "id").limit(params.sample).select("v").toPandas()
    mean, projection = learn(np.array(some["v"].tolist(), dtype=np.float64), params)
    return _rerank(_near_pairs(_codes(classes, mean, projection, params.parts), params.parts), classes, params.cosine)


def near_vectors(table: DataFrame, params: ItqParams | None = None, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per row of ``table``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing. Vectors of different lengths have no cosine and are not
    linked; each length has a rotation and tables of its own.
    Equal vectors are one class: they link with each other and share their
    class's links. Rows with a null id have null results and are kept. Repeated
    ids with one vector count as one row of the class each.
    """
    params = params or ItqParams()
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    usable = rows.filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    classes = stash(usable.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    widths = classes.groupBy(F.size("v").alias("d")).count().filter("count > 1").orderBy("d").collect()
    none = classes.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("cosine")).limit(0)
    links = stash(reduce(DataFrame.unionByName, [_links(classes.filter(F.size("v") == w.d), params) for w in widths], none))
    comp = connected_components(links.select("a", "b"))
    size = classes.select(F.col("id").alias("other"), "copies")
    linked = (links.select(F.col("a").alias("class"), F.col("b").alias("other"))
              .union(links.select("b", "a")).join(size, "other")
              .groupBy("class").agg(F.sum("copies").alias("to_others")))
    per_class = (classes.select("v", F.col("id").alias("class"), "copies")
                 .join(linked, "class", "left").join(comp.withColumnRenamed("id", "class"), "class", "left")
                 .select("v", (F.col("copies") - 1 + F.coalesce("to_others", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "class").alias("component_id")))
    matched = usable.join(per_class, "v").select("id", "n_links", "component_id")
    odd = (rows.filter(F.col("id").isNull() | ~F.coalesce(fine, F.lit(False)))
           .select("id", F.when(F.col("id").isNotNull(), F.lit(0)).cast("long").alias("n_links"),
                   F.col("id").alias("component_id")))
    return matched.unionByName(odd).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
