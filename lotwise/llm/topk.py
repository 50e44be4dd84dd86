"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are dealt to a few lists; each list knows a local score for every vector and query, and the score is their sum.
First, each list sends its best vectors for a query; resolving their whole scores gives a cutoff t that the k-th
best score can't be below. A vector whose local scores are all under t / lists falls short of it, so in the second phase each list
sends every entry that reaches that uniform threshold, and no others can be among the best. Vectors that all lists have sent raise the
cutoff; of the others those whose known scores, with the threshold in place of the unknown ones, can't reach it are dropped. The
third phase asks the lists for the scores still missing. Nothing is estimated: all scores are integers.

Lists hold vectors in blocks and meet queries in blocks, one row for each list, block of vectors and block of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

LISTS = 2
BLOCK_VECTORS, BLOCK_QUERIES = 4_096, 512
TASKS = 10_000  # tasks that pairs of blocks are dealt to, at most
CHUNK = 64  # queries, or thousands of pairs, that are scored at a time
LOWEST = -(1 << 63)
REACH = 58  # bits of a local score, so that the sum of up to 16 of them is a long
BLOCK = ["size", "vb", "qb"]
PAIRS = "size int, vb int, qb int, qi binary, vi binary, known binary, seen binary"
INTS = (np.int8, np.int16, np.int32, np.int64)


def integer_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id (long) and v (array<long>): floor(scale * x) of each component x, taken as double; distinct rows.

    Null ids, and vectors that are null or hold null or non-finite components, are left out.
    """
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].cast("array<double>").alias("e"))
            .where(F.col("vec_id").isNotNull() & F.col("e").isNotNull()).where(finite)
            .select("vec_id", F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")).distinct())


def packed(matrix: np.ndarray) -> tuple[int, bytes]:
    """Width in bytes of the narrowest integers that hold the matrix, and its bytes."""
    kind = next(t for t in INTS if not matrix.size or (np.iinfo(t).min <= matrix.min() and matrix.max() <= np.iinfo(t).max))
    return np.dtype(kind).itemsize, matrix.astype(kind).tobytes()


def unpacked(width: int, data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"i{width}").reshape(rows, -1) if data else np.zeros((rows, 0), np.int64)


def wide_enough(left: np.ndarray, right: np.ndarray) -> type:
    """A type in which inner products of rows of the two are exact."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (left, right)]
    bound = most[0] * most[1] * max(left.shape[1], 1)
    return float if bound < 2.0**52 else np.int64 if bound < 2.0**REACH else object


def held(scores: np.ndarray) -> np.ndarray:
    """As 64-bit integers; what lies beyond REACH bits is held to them."""
    return (np.clip(scores, -(1 << REACH), 1 << REACH) if scores.dtype == object else scores).astype(np.int64)


def blocks(vectors: DataFrame, count: int, name: str, lists: int) -> DataFrame:
    """One row for each block and list: size, ``name`` (block), list, ids and keys (int64), width and data of its components."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        size, block = int(rows["size"].iloc[0]), int(rows[name].iloc[0])
        rows = rows.sort_values(["vec_id", "key"])
        whole = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), size)
        ids, keys = rows["vec_id"].to_numpy(np.int64).tobytes(), rows["key"].to_numpy(np.int64).tobytes()
        parts = [packed(m) for m in np.array_split(whole, lists, axis=1)]
        return pd.DataFrame([(size, block, j, ids, keys, width, data) for j, (width, data) in enumerate(parts)],
                            columns=["size", name, "list", "ids", "keys", "width", "data"])

    place = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(count)).cast("int")
    return (vectors.select("vec_id", "v", F.xxhash64("vec_id", "v").alias("key"), F.size("v").alias("size"), place.alias(name))
            .groupBy("size", name).applyInPandas(pack, f"size int, {name} int, list int, ids binary, keys binary, width int, data binary"))


def exploded(rows: DataFrame, count: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def met(index: DataFrame, asked: DataFrame, vector_blocks: int, query_blocks: int, lists: int) -> DataFrame:
    """Each block of vectors with each block of queries, list by list."""
    index, asked = index.drop("ids"), asked.drop("ids")
    tasks = min(vector_blocks * query_blocks * lists, TASKS)
    left = exploded(index, query_blocks, "qb").repartition(tasks, *BLOCK, "list")
    right = exploded(asked, vector_blocks, "vb").repartition(tasks, *BLOCK, "list")
    for c in ("keys", "width", "data"):
        right = right.withColumnRenamed(c, f"q_{c}")
    return left.join(right, [*BLOCK, "list"])


def _opened(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys, asked = np.frombuffer(r.keys, np.int64), np.frombuffer(r.q_keys, np.int64)
    return unpacked(r.width, r.data, len(keys)), unpacked(r.q_width, r.q_data, len(asked)), keys, asked


def _local(r):
    """First query of a chunk, local scores (queries, vectors), and which are a query's own vector."""
    vectors, queries, keys, asked = _opened(r)
    kind = wide_enough(vectors, queries)
    turned = vectors.astype(kind).T
    for at in range(0, len(queries), CHUNK):
        yield at, held(queries[at:at + CHUNK].astype(kind) @ turned), asked[at:at + CHUNK, None] == keys[None, :]


def gathered(pairs: DataFrame, k: int) -> DataFrame:
    """Phase one: size, vb, qb, list, qi, vi, local: the k best local scores of every block for each query."""
    def best(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                for at, scores, own in _local(r):
                    scores = np.where(own, LOWEST, scores)
                    n = min(k, scores.shape[1])
                    top = np.argpartition(-scores.astype(float), n - 1, axis=1)[:, :n] if n < scores.shape[1] else np.tile(np.arange(n), (len(scores), 1))
                    qi = np.repeat(np.arange(at, at + len(scores)), n)
                    vi = top.ravel()
                    keep = ~own[qi - at, vi]
                    yield pd.DataFrame({"size": r.size, "vb": r.vb, "qb": r.qb, "list": r.list, "qi": qi[keep], "vi": vi[keep],
                                        "local": scores[qi - at, vi][keep]})

    return pairs.mapInPandas(best, "size int, vb int, qb int, list int, qi int, vi int, local long")


def collected(pairs: DataFrame) -> DataFrame:
    """Phase two: for each list, entries whose local score reaches the query's threshold (column ``least``, by query of the block)."""
    def reach(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                least = np.full(len(r.q_keys) // 8, LOWEST, np.int64)
                for c in [] if r.least is None else r.least:
                    least[c["qi"]] = c["least"]
                found = []
                for at, scores, own in _local(r):
                    q, v = np.nonzero((scores >= least[at:at + len(scores), None]) & ~own)
                    found.append((q + at, v, scores[q, v]))
                qi, vi, local = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found, strict=True))
                yield pd.DataFrame({"size": [r.size], "vb": [r.vb], "qb": [r.qb], "list": [r.list], "qi": [qi.astype(np.int32).tobytes()],
                                    "vi": [vi.astype(np.int32).tobytes()], "local": [local.astype(np.int64).tobytes()]})

    return pairs.mapInPandas(reach, "size int, vb int, qb int, list int, qi binary, vi binary, local binary")


def summed(entries: DataFrame) -> DataFrame:
    """The lists' entries of each pair of blocks brought together: known (sum of local scores) and seen (a bit for each list)."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        qi, vi, local = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("qi", np.int32), ("vi", np.int32), ("local", np.int64)))
        lists = np.concatenate([np.full(len(x) // 4, 1 << j, np.int64) for x, j in zip(rows["qi"], rows["list"], strict=True)])
        order = np.lexsort((vi, qi))
        qi, vi = qi[order], vi[order]
        first = np.flatnonzero(np.concatenate([[len(qi) > 0], (qi[1:] != qi[:-1]) | (vi[1:] != vi[:-1])])[:len(qi)])
        sums = [np.add.reduceat(x[order], first) if len(first) else np.zeros(0, np.int64) for x in (local, lists)]
        one = rows.iloc[0]
        return pd.DataFrame([(one["size"], one["vb"], one["qb"], qi[first].tobytes(), vi[first].tobytes(), sums[0].tobytes(),
                              sums[1].astype(np.int32).tobytes())], columns=[*BLOCK, "qi", "vi", "known", "seen"])

    return entries.groupBy(*BLOCK).applyInPandas(add, PAIRS)


def resolved(rows: DataFrame, pairs: DataFrame, lists: int) -> DataFrame:
    """Phase three: each list adds the local scores that are missing; all lists are seen afterwards."""
    for j in range(lists):
        def add(batches, bit=1 << j):
            for part in batches:
                done = []
                for r in part.itertuples(index=False):
                    vectors, queries, _, _ = _opened(r)
                    kind = wide_enough(vectors, queries)
                    qi, vi, seen = (np.frombuffer(x, np.int32) for x in (r.qi, r.vi, r.seen))
                    known = np.frombuffer(r.known, np.int64).copy()
                    missing = np.flatnonzero(seen & bit == 0)
                    for at in range(0, len(missing), CHUNK * 1000):
                        m = missing[at:at + CHUNK * 1000]
                        known[m] += held((queries[qi[m]].astype(kind) * vectors[vi[m]].astype(kind)).sum(1))
                    done.append((r.size, r.vb, r.qb, r.qi, r.vi, known.tobytes(), (seen | bit).astype(np.int32).tobytes()))
                yield pd.DataFrame(done, columns=[*BLOCK, "qi", "vi", "known", "seen"])

        rows = rows.join(pairs.where(F.col("list") == j), BLOCK).mapInPandas(add, PAIRS)
    return rows


def whole_scores(rows: DataFrame, lists: int, k: int) -> DataFrame:
    """size, qb, qi, score: the k best scores of each pair of blocks for each query, of vectors that all lists have seen."""
    def best(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                seen = np.frombuffer(r.seen, np.int32) == (1 << lists) - 1
                qi, known = np.frombuffer(r.qi, np.int32)[seen], np.frombuffer(r.known, np.int64)[seen]
                order = np.lexsort((~known, qi))
                qi, known = qi[order], known[order]
                keep = _within(qi) < k
                yield pd.DataFrame({"size": r.size, "qb": r.qb, "qi": qi[keep], "score": known[keep]})

    return rows.mapInPandas(best, "size int, qb int, qi int, score long")


def _within(groups: np.ndarray) -> np.ndarray:
    """Place of each entry inside its run of equal values."""
    first = np.concatenate([[len(groups) > 0], groups[1:] != groups[:-1]])[:len(groups)]
    starts = np.flatnonzero(first)
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))


def cutoffs(scores: DataFrame, k: int) -> DataFrame:
    """size, qb, qi, cut: the k-th best score; queries with fewer have none."""
    place = F.row_number().over(W.partitionBy("size", "qb", "qi").orderBy(F.desc("score")))
    return scores.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).select(
        "size", "qb", "qi", F.col("score").alias("cut"))


def by_block(cuts: DataFrame, value: Column, name: str) -> DataFrame:
    """size, qb and an array of (qi, value), a block's queries at most."""
    return cuts.groupBy("size", "qb").agg(F.collect_list(F.struct("qi", value.alias(name))).alias(name))


def within_reach(rows: DataFrame, lists: int) -> DataFrame:
    """Pairs that can still reach the cutoff: what is known, with less than the threshold for each list not seen."""
    def keep(batches):
        for part in batches:
            done = []
            for r in part.itertuples(index=False):
                qi, vi, seen = (np.frombuffer(x, np.int32) for x in (r.qi, r.vi, r.seen))
                known = np.frombuffer(r.known, np.int64)
                size = int(qi.max()) + 1 if len(qi) else 0
                cut, least = np.full(size, -np.inf), np.zeros(size)
                for c in [] if r.cut is None else r.cut:
                    if c["qi"] < size:
                        cut[c["qi"]], least[c["qi"]] = c["cut"]["cut"], c["cut"]["least"]
                unseen = lists - sum((seen >> j) & 1 for j in range(lists))
                # in doubles, so a little slack
                most = known + unseen * (least[qi] - 1)
                left = (unseen == 0) | (most + 1e-9 * np.abs(most) + 1 >= cut[qi])
                done.append((r.size, r.vb, r.qb, qi[left].tobytes(), vi[left].tobytes(), known[left].tobytes(), seen[left].tobytes()))
            yield pd.DataFrame(done, columns=[*BLOCK, "qi", "vi", "known", "seen"])

    return rows.mapInPandas(keep, PAIRS)


def named(rows: DataFrame, index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, query_key, vec_id, key, score: the k best of each pair of blocks for each query."""
    left = index.where("list = 0").select("size", "vb", "ids", "keys")
    right = asked.where("list = 0").select("size", "qb", F.col("ids").alias("q_ids"), F.col("keys").alias("q_keys"))
    def few(part):
        done = []
        for r in part.itertuples(index=False):
            qi, vi, known = np.frombuffer(r.qi, np.int32), np.frombuffer(r.vi, np.int32), np.frombuffer(r.known, np.int64)
            order = np.lexsort((vi, ~known, qi))  # places in a block go by id, then key
            order = order[_within(qi[order]) < k]
            done.append((r.size, r.vb, r.qb, qi[order].tobytes(), vi[order].tobytes(), known[order].tobytes(), b""))
        return pd.DataFrame(done, columns=[*BLOCK, "qi", "vi", "known", "seen"])

    def best(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                qi, vi, known = np.frombuffer(r.qi, np.int32), np.frombuffer(r.vi, np.int32), np.frombuffer(r.known, np.int64)
                ids, keys, asked, asked_keys = (np.frombuffer(x, np.int64) for x in (r.ids, r.keys, r.q_ids, r.q_keys))
                yield pd.DataFrame({"query_id": asked[qi], "query_key": asked_keys[qi], "vec_id": ids[vi], "key": keys[vi], "score": known})

    joined = rows.mapInPandas(lambda batches: map(few, batches), PAIRS).join(left, ["size", "vb"]).join(right, ["size", "qb"])
    return joined.mapInPandas(best, "query_id long, query_key long, vec_id long, key long, score long")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, lists: int = LISTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score, query_key: the k greatest inner products of each query with other rows.

    vectors and queries: vec_id, embedding; other columns are left behind. Components become floor(scale * x). Ties go to the smaller
    vec_id. Null ids, and vectors that are null or hold null or non-finite components, take no part; vectors of different sizes
    are not compared, and empty ones score 0. Rows that agree in id and integer vector count once; rows of one id with different
    vectors are rows of their own, told apart by query_key, and are compared with each other. A list's local
    score beyond 58 bits is held to them. Of equal vectors only the k + 1 smallest ids can be among the best, so only they are searched.
    """
    if not 1 <= lists <= 16:
        raise ValueError("1 to 16 lists")
    same = W.partitionBy("v").orderBy("vec_id")
    kept = stored(integer_vectors(vectors, scale).withColumn("turn", F.row_number().over(same)).where(F.col("turn") <= k + 1).drop("turn"))
    asked = stored(integer_vectors(queries, scale))
    vector_blocks, query_blocks = max(1, -(-kept.count() // BLOCK_VECTORS)), max(1, -(-asked.count() // BLOCK_QUERIES))
    index, probes = stored(blocks(kept, vector_blocks, "vb", lists)), stored(blocks(asked, query_blocks, "qb", lists))
    pairs = met(index, probes, vector_blocks, query_blocks, lists)

    local = W.partitionBy("size", "qb", "qi", "list").orderBy(F.desc("local"))
    first = gathered(pairs, k).withColumn("place", F.row_number().over(local)).where(F.col("place") <= k)
    asked_for = first.groupBy(*BLOCK).agg(F.collect_set(F.struct("qi", "vi")).alias("entries"))

    def unseen(batches):
        for part in batches:
            done = []
            for r in part.itertuples(index=False):
                qi, vi = (np.array([e[c] for e in r.entries], np.int32) for c in ("qi", "vi"))
                done.append((r.size, r.vb, r.qb, qi.tobytes(), vi.tobytes(), np.zeros(len(qi), np.int64).tobytes(), np.zeros(len(qi), np.int32).tobytes()))
            yield pd.DataFrame(done, columns=[*BLOCK, "qi", "vi", "known", "seen"])

    cut = cutoffs(whole_scores(resolved(asked_for.mapInPandas(unseen, PAIRS), pairs, lists), lists, k), k)
    # an entry below this can't be its list's part of a score that reaches the cutoff
    cut = stored(cut.withColumn("least", F.expr(f"cut div {lists}") - 1))
    least = by_block(cut, F.col("least"), "least")
    sent = stored(summed(collected(pairs.join(least, ["size", "qb"], "left"))))

    raised = cutoffs(whole_scores(sent, lists, k), k)
    higher = cut.withColumnRenamed("cut", "first").join(raised, ["size", "qb", "qi"], "left").select(
        "size", "qb", "qi", F.struct(F.greatest("first", "cut").alias("cut"), "least").alias("both"))
    left = within_reach(sent.join(by_block(higher, F.col("both"), "cut"), ["size", "qb"], "left"), lists)
    found = named(resolved(left, pairs, lists), index, probes, k)
    best = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", "query_key")


def op13_topk(spark, sf_dir: str) -> DataFrame:
    """The twenty greatest integer inner products of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0)).select("query_id", "rank", "vec_id", "score")
