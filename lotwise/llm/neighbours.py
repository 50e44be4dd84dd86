"""Nearest neighbours by randomly rotated one-bit codes.

A vector is taken as its unit vector less the mean of all unit vectors, rotated at random and reduced to the signs of its
components, packed into bits, and two numbers: its length and the inner product of its direction with its code. For any query these give an unbiased
estimate of the inner product and a bound on its error. Vectors and queries meet in blocks: within a block the best estimates are
measured first, then every vector whose upper bound reaches the k-th best measured one, so original vectors decide the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

BLOCK_VECTORS, BLOCK_QUERIES = 8_192, 2_048
LEAST_BLOCKS = 32  # of vectors, so that small tables use all cores
BOUND = 3.0  # standard deviations of an estimate that the error bound spans


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is drawn."""
    q, r = np.linalg.qr(np.random.default_rng(seed + size).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length of (unit - centre), and inner product of its direction with its code."""
    turned = (unit - centre) @ turn.T
    length = np.linalg.norm(turned, axis=1)
    bits = turned > 0
    agree = np.abs(turned).sum(1) / np.sqrt(turned.shape[1]) / np.maximum(length, 1e-300)
    return np.packbits(bits, axis=1), length, np.where(length > 0, agree, 1.0)


def estimates(codes: np.ndarray, length: np.ndarray, agree: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray,
              spread: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines and error bounds (queries, vectors) from codes; queries are unit vectors."""
    size = queries.shape[1]
    rest = (queries - centre) @ turn.T
    rest_length = np.linalg.norm(rest, axis=1)
    signs = (np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    inner = rest.astype(np.float32) @ signs.T
    # <u, q> = <u - c, q - c> + <u, c> + <q, c> - <c, c>, where <u, c> follows from the length of u - c
    centred = (inner / agree.astype(np.float32)) * length.astype(np.float32)
    cc = float(centre @ centre)
    with_centre = (1 + cc - length**2) / 2
    value = centred + (with_centre[None, :] + (queries @ centre)[:, None] - cc).astype(np.float32)
    error = spread * np.sqrt(np.maximum(1 - agree**2, 0)) / agree / np.sqrt(max(size - 1, 1)) * length
    return value, (rest_length[:, None] * error[None, :]).astype(np.float32)


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; each depends on its own two vectors only."""
    return (vectors * query).sum(1) / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((query * query).sum()))


def block_search(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, centres: dict[int, np.ndarray]) -> pd.DataFrame:
    """The k nearest of one block of vectors to each query of one block of queries, measured on original vectors."""
    out = []
    for size in sorted(set(vectors["size"]) & set(queries["size"])):
        own, asked = vectors[vectors["size"] == size], queries[queries["size"] == size]
        ids = own["vec_id"].to_numpy()
        original = np.stack(own["embedding"].to_numpy()).astype(float)
        codes = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1)
        probes = np.stack(asked["embedding"].to_numpy()).astype(float)
        unit = probes / np.sqrt((probes * probes).sum(1))[:, None]
        names = asked["vec_id"].to_numpy()
        for at in range(0, len(asked), 256):
            value, error = estimates(codes, own["length"].to_numpy(), own["agree"].to_numpy(), unit[at:at + 256], centres[size], rotation(size))
            for j in range(len(value)):
                query = names[at + j]
                v = np.where(ids == query, -np.inf, value[j])
                if len(v) > k:
                    best = np.argpartition(-v, k)[:k]
                    kth = np.sort(np.where(ids[best] == query, -np.inf, cosines(original[best], probes[at + j])))[0]
                    best = np.flatnonzero(v + error[j] >= kth)
                    best = np.union1d(best, np.argpartition(-v, k)[:k])
                else:
                    best = np.arange(len(v))
                best = best[ids[best] != query]
                exact = cosines(original[best], probes[at + j])
                order = np.lexsort((ids[best], -exact))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best][order], "score": exact[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the k nearest vectors found for each query, itself excluded.

    vectors and queries: vec_id, embedding. Ties go to the smaller vec_id. Null ids, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part; vectors of different sizes are not compared. Repeated rows of one id and vector count once.
    Of equal vectors only the k + 1 smallest ids can be among the nearest, so only they are searched.
    """
    size = F.size("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)

    def clean(rows: DataFrame) -> DataFrame:
        return (rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].cast("array<double>").alias("embedding"))
                .where(F.col("vec_id").isNotNull() & (size > 0) & finite).where((square > 0) & (square < float("inf")))
                .withColumn("size", size))

    same = W.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    once = clean(vectors).withColumn("_turn", F.dense_rank().over(same)).where(F.col("_turn") <= k + 1)
    kept = stored(once.dropDuplicates(["vec_id", "embedding"]).drop("_turn"))
    count = kept.count()
    # mean unit vector of each size
    unit = kept.select("size", F.posexplode(F.transform("embedding", lambda x: x / F.sqrt(square))).alias("i", "x"))
    means = unit.groupBy("size", "i").agg(F.avg("x").alias("x")).groupBy("size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centre")).collect()  # one vector per size
    centres = {r["size"]: np.array(r["centre"]) for r in means}
    asked = stored(clean(queries).dropDuplicates(["vec_id", "embedding"]))
    blocks = max(LEAST_BLOCKS, -(-count // BLOCK_VECTORS))
    query_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def coded(batches):
        for part in batches:
            codes, lengths, agrees = [None] * len(part), np.zeros(len(part)), np.zeros(len(part))
            for size in set(part["size"]):
                at = np.flatnonzero(part["size"] == size)
                v = np.stack(part["embedding"].iloc[at].to_numpy()).astype(float)
                code, lengths[at], agrees[at] = encode(v / np.linalg.norm(v, axis=1)[:, None], centres[size], rotation(size))
                for i, c in zip(at, code, strict=True):
                    codes[i] = c.tobytes()
            yield part.assign(code=codes, length=lengths, agree=agrees)

    index = kept.mapInPandas(coded, "vec_id long, embedding array<double>, size int, code binary, length double, agree double")
    place = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    left = index.withColumn("vb", place).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = (asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit("ask")), F.lit(query_blocks)).cast("int"))
             .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(
        lambda v, q: block_search(v, q, k, centres), "query_id long, vec_id long, score double")
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once_each = found.dropDuplicates(["query_id", "vec_id"]) if k else found
    return once_each.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_neighbours(spark, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0))
