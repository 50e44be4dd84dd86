"""Exact n-gram Jaccard join in metric space: pivots, regions, triangle-inequality windows, recursion.

Jaccard distance is a metric. Documents that can have a partner at all (at least 75 % of their shingles
occur elsewhere) are dealt into regions: each shingle is a pivot set, a document lies nearest to the pivots it contains, and
it enters the regions of its first n - ceil(0.75 n) + 1 pivots in one global order, the least number that
makes every linked pair meet. Inside a region documents become pivots: each is measured against all others, documents within the
threshold join its component, and members of its component stay for the next round only if some other
document's distance to the pivot is within the threshold of theirs, as the triangle inequality demands. Regions
whose documents are all in one component are done; small ones are joined directly; the rest recurse.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import python_batches, stored, table, texts
from .graph import components
from .wordhash import WordHasher, shingles

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100  # link when DENOMINATOR * common >= NUMERATOR * union
PACK_BYTES = 16 << 20  # text per bucket of packed shingles
SMALL = 64  # documents of a region that is joined directly
PIVOTS = 16  # per region in the first round, GROWTH times as many in each further one
GROWTH = 4_096
WINDOWS = 2  # pivots of a region whose distances send members away
FREQUENT = 100_000  # shingles whose frequency orders the pivots, at most
BROADCAST_KEYS = 1_000_000  # 64-bit keys, so a few tens of MB as a hash table
ONE = np.uint64(1)


def _sets(batch_texts: list, hasher: WordHasher) -> list[np.ndarray]:
    return [shingles(hasher((t or "").encode("utf-8", "surrogatepass").lower().split())) for t in batch_texts]


def shared_counts(nodes: DataFrame, buckets: int) -> DataFrame:
    """node, n, shared: size of each node's set, and how many of its shingles another node holds too.

    nodes: node, text. Shingles travel packed: one row holds all shingles of a batch of documents that fall into
    one of ``buckets`` hash ranges, 40 bits each with a byte for the document. A false match of 40 bits can
    only raise a count. A shingle common to many documents is one entry per document, never a group.
    """
    bits = buckets.bit_length() - 1
    python_batches(nodes.sparkSession, 250)
    names = ["bucket", "batch", "nodes", "hashes", "places"]

    def pack(batches):
        hasher = WordHasher()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.array(batch.column(0).to_pylist(), np.int64)
            sets = _sets(batch.column(1).to_pylist(), hasher)
            sizes = np.array([len(s) for s in sets], np.int64)
            name = int(np.bitwise_xor.reduce(keys * np.arange(1, 2 * len(keys), 2)))
            rows = [(-1, name, keys.tobytes(), sizes.tobytes(), b"")]
            every, place = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint8), sizes)
            order = np.argsort(every)
            every, place = every[order], place[order]
            edges = np.searchsorted(every >> np.uint64(64 - bits), np.arange(buckets + 1, dtype=np.uint64))
            short = ((every << np.uint64(bits)) >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
            for b in range(buckets):
                if edges[b] < edges[b + 1]:
                    part = slice(edges[b], edges[b + 1])
                    rows.append((b, name, keys.tobytes(), short[part].tobytes(), place[part].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] < 0:
            return pd.DataFrame({"batch": rows["batch"], "nodes": rows["nodes"], "size": True, "counts": rows["hashes"]})
        sizes = np.array([len(p) for p in rows["places"]])
        wide = np.zeros((sizes.sum(), 8), np.uint8)
        wide[:, :5] = np.frombuffer(b"".join(rows["hashes"]), np.uint8).reshape(-1, 5)
        values = wide.view(np.uint64).ravel()
        order = np.argsort(values)
        ordered = values[order]
        same = ordered[1:] == ordered[:-1]
        shared = np.zeros(len(values), bool)
        shared[order[1:]] |= same
        shared[order[:-1]] |= same
        ends = np.cumsum(sizes)
        out = [np.bincount(np.frombuffer(p, np.uint8)[shared[e - len(p):e]], minlength=len(k) // 8).astype(np.int64).tobytes()
               for p, k, e in zip(rows["places"], rows["nodes"], ends, strict=True)]
        return pd.DataFrame({"batch": rows["batch"], "nodes": rows["nodes"], "size": False, "counts": out})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for keys, own in rows.groupby("nodes"):
            keys = np.frombuffer(keys, np.int64)
            total = {s: sum((np.frombuffer(c, np.int64) for c in own.loc[own["size"] == s, "counts"]), np.zeros(len(keys), np.int64)) for s in (True, False)}
            parts.append(pd.DataFrame({"node": keys, "n": total[True], "shared": total[False]}))
        return pd.concat(parts)

    packed = nodes.select("node", "text").mapInArrow(pack, "bucket int, batch long, nodes binary, hashes binary, places binary")
    counted = packed.groupBy("bucket", F.when(F.col("bucket") < 0, F.col("batch")).alias("_b")).applyInPandas(
        count, "batch long, nodes binary, size boolean, counts binary")
    return counted.groupBy("batch").applyInPandas(add, "node long, n long, shared long")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """x, p, d (distance) and link of each pair x, p of nodes."""
    left = pairs.join(sets.select(F.col("node").alias("p"), F.col("hashes").alias("hp")), "p")
    both = left.join(sets.select(F.col("node").alias("x"), F.col("hashes").alias("hx")), "x").select("x", "p", "hx", "hp")

    def measure(batches):
        for batch in batches:
            common, union = [], []
            for hx, hp in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(hx.as_buffer(), np.uint64), np.frombuffer(hp.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common.append(int((b[at] == a).sum()))
                union.append(len(a) + len(b) - common[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                                             names=["x", "p", "common", "every"])

    return both.mapInArrow(measure, "x long, p long, common long, every long").select(
        "x", "p", (1 - F.col("common") / F.col("every")).alias("d"), (DENOMINATOR * F.col("common") >= NUMERATOR * F.col("every")).alias("link"))


def _postings(sets: DataFrame) -> DataFrame:
    """s, x, n, pos: the regions that each live document enters, and the place of the pivot in its order.

    Pivots are ordered by frequency in a sample of one document in eight, then by hash. Only shingles that are frequent there
    have a rank, at most FREQUENT of them; any order is right as long as all documents use the same one.
    """
    spark = sets.sparkSession
    python_batches(spark)

    def every(batches):
        for batch in batches:
            for h in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, np.int64))], names=["s"])

    sample = sets.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(8)) == 0).select("hashes")
    often = (sample.mapInArrow(every, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 3)
             .orderBy(F.desc("n"), "s").limit(FREQUENT).toPandas())
    keys = often["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast((keys[order], often["n"].to_numpy(np.int64)[order]))

    def enter(batches):
        known, times = sent.value
        for batch in batches:
            out_s, out_x, out_n, out_pos = [], [], [], []
            for node, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = np.frombuffer(blob, np.uint64)
                take = n - -(-n * NUMERATOR // DENOMINATOR) + 1
                rank = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    rank = np.where(known[at] == h, times[at], 0)
                first = h[np.lexsort((h, rank))[:take]]
                out_s.append(first)
                out_x.append(np.full(len(first), node, np.int64))
                out_n.append(np.full(len(first), n, np.int64))
                out_pos.append(np.arange(len(first)))
            if out_s:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_s).view(np.int64)), pa.array(np.concatenate(out_x)),
                                                  pa.array(np.concatenate(out_n)), pa.array(np.concatenate(out_pos))],
                                                 names=["s", "x", "n", "pos"])

    return sets.select("node", "n", "hashes").mapInArrow(enter, "s long, x long, n long, pos long")


def _distinct_regions(entered: DataFrame) -> DataFrame:
    """s, docs: regions of more than one document; of those with equal members the first in the order of pivots.

    Two documents first meet in their first common pivot's region, and no region with equal members comes before that one but itself.
    """
    members = entered.groupBy("s").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.xxhash64("x", F.lit("a")) % (1 << 40)).alias("sum_a"),
                                       F.sum(F.xxhash64("x", F.lit("b")) % (1 << 40)).alias("sum_b"), F.min(F.struct("x", "pos"))["pos"].alias("pos"))
    return members.where(F.col("docs") > 1).groupBy("docs", "sum_a", "sum_b").agg(F.min_by("s", F.struct("pos", "s")).alias("s")).select("s", "docs")


def _merged(names: DataFrame, found: DataFrame) -> DataFrame:
    """names (node, label) after the links a, b: labels that a link joins become the smallest of them."""
    ends = found.join(names.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(
        names.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
    joined = components(ends.where(F.col("la") != F.col("lb")).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    to = joined.select(F.col("id").alias("label"), F.col("label").alias("least"))
    return stored(names.join(to, "label", "left").select("node", F.coalesce("least", "label").alias("label")))


def linked(sets: DataFrame) -> DataFrame:
    """node, label: the component of each node under all links. sets: node, n, hashes (sorted 64-bit numbers).

    The first round's pivots come from all documents of a region, later ones from those outside its largest component,
    so a region ends when each of these has been a pivot.
    """
    entered = stored(_postings(sets))
    crowd = _distinct_regions(entered)
    names = sets.select("node", F.col("node").alias("label"))
    placed = stored(entered.join(crowd, "s"))
    active = stored(placed.select("s", "x", "n", "pos", "docs", F.col("x").alias("label"), F.lit(True).alias("ask")))
    done, classes_ = None, PIVOTS
    # a linked pair must be able to have all it shares from its first common pivot on; elsewhere it need not meet
    near = (DENOMINATOR * F.least("n", "np") >= NUMERATOR * F.greatest("n", "np")) & (
        (NUMERATOR + DENOMINATOR) * F.least(F.col("n") - F.col("pos"), F.col("np") - F.col("ppos")) >= NUMERATOR * (F.col("n") + F.col("np")))
    while not active.isEmpty():
        few, many = active.where(F.col("docs") <= SMALL), active.where(F.col("docs") > SMALL)
        # small regions: every pair of at most SMALL documents
        other = few.where("ask").select("s", F.col("x").alias("p"), F.col("n").alias("np"), F.col("pos").alias("ppos"), F.col("label").alias("lp"))
        direct = few.join(other, "s").where((~F.col("ask") | (F.col("x") > F.col("p"))) & (F.col("label") != F.col("lp")) & near)
        # large ones: a few pivots, one from each hash class
        first = many.where("ask").groupBy("s", F.pmod(F.xxhash64("x", F.lit(classes_)), F.lit(classes_)).alias("k")).agg(
            F.min_by(F.struct("x", "n", "pos", "label"), "x").alias("v"))
        chosen = stored(first.select("s", F.col("v.x").alias("p"), F.col("v.n").alias("np"), F.col("v.pos").alias("ppos"), F.col("v.label").alias("lp")))
        asked = many.join(chosen, "s").where((F.col("label") != F.col("lp")) & near)
        ordered = [F.greatest("x", "p").alias("x"), F.least("x", "p").alias("p")]  # a pair is measured once
        pairs = direct.select(*ordered).unionByName(asked.select(*ordered)).distinct()
        if done is not None:
            pairs = pairs.join(done.select("x", "p"), ["x", "p"], "left_anti")
        measured = stored(_distances(pairs, sets))
        done = measured if done is None else done.unionByName(measured)
        found = measured.where("link").select(F.col("x").alias("a"), F.col("p").alias("b"))
        if not found.isEmpty():
            names = _merged(names, found)
        if chosen.isEmpty():
            break
        label = names.withColumnRenamed("node", "x")
        left = many.select("s", "x", "n", "pos").join(chosen.select("s", F.col("p").alias("x")), ["s", "x"], "left_anti")
        # a document's label is looked up once for all its regions, of which it has n / 4 + 1 at most
        by_document = left.groupBy("x", "n").agg(F.collect_list(F.struct("s", "pos")).alias("regions")).join(label, "x")
        own = by_document.select("x", "n", "label", F.explode("regions").alias("r")).select("r.s", "x", "n", "r.pos", "label")
        # the largest component of each region; only its pivots can send members away
        shares = own.groupBy("s", "label").agg(F.count(F.lit(1)).alias("docs"))
        largest = shares.groupBy("s").agg(F.max(F.struct("docs", "label"))["label"].alias("main"), F.sum("docs").alias("docs"),
                                          F.count(F.lit(1)).alias("parts")).where(F.col("parts") > 1)
        own = stored(own.join(largest, "s").select("s", "x", "n", "pos", "label", "docs", (F.col("label") != F.col("main")).alias("ask")))
        pivots = chosen.select("s", F.col("p").alias("x"), "np").join(label, "x").select("s", F.col("x").alias("p"), "np", F.col("label").alias("lp"))
        mains = own.where(~F.col("ask")).groupBy("s").agg(F.min("label").alias("lp"))
        # two pivots of a region are enough to send members away
        first = F.row_number().over(W.partitionBy("s").orderBy("p"))
        main_pivots = pivots.join(mains, ["s", "lp"], "left_semi").withColumn("k", first).where(F.col("k") <= WINDOWS).drop("k")
        to = own.join(main_pivots, "s")
        both = to.withColumn("hi", F.greatest("x", "p")).withColumn("lo", F.least("x", "p")).join(
            done.select(F.col("x").alias("hi"), F.col("p").alias("lo"), "d"), ["hi", "lo"], "left")
        # where a distance wasn't measured, sizes still give its least value
        reach = both.where("ask").groupBy("s", "p").agg(F.min(F.coalesce("d", 1 - F.least("n", "np") / F.greatest("n", "np"))).alias("reach"))
        radius = 1 - NUMERATOR / DENOMINATOR
        away = both.where(~F.col("ask") & F.col("d").isNotNull()).join(reach, ["s", "p"]).where(
            F.col("d") < F.col("reach") - radius - 1e-9).select("s", "x").distinct()
        active = stored(own.join(away, ["s", "x"], "left_anti"))
        classes_ *= GROWTH
    return names


def _sized(keys: DataFrame) -> DataFrame:
    """Keys to join texts with: sent to all tasks up to BROADCAST_KEYS, so that texts stay where they are; shuffled beyond."""
    kept = stored(keys)
    return F.broadcast(kept) if kept.count() <= BROADCAST_KEYS else kept


def classes(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, n_shingles, component_id of every row.

    component_id is the smallest doc_id reachable by links. Rows of equal text are one node, so a text's copies cost nothing.
    Documents without words, or without text, have no shingle and are linked with nothing. Null ids: such rows take
    part, and a component without any id has a null component_id.
    """
    rows = texts(docs)
    keyed = rows.select("row_key", "doc_id", "text", F.xxhash64("text", F.lit("node")).alias("node"))
    info = stored(keyed.select("row_key", "doc_id", "node", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")))
    first = info.groupBy("node").agg(F.min("row_key").alias("first"), F.count(F.lit(1)).alias("rows"))
    copies = _sized(info.join(first.where("rows > 1"), "node").where(F.col("row_key") != F.col("first")).select("row_key").distinct())
    nodes = keyed.join(copies, "row_key", "left_anti").where(F.col("text").isNotNull()).select("node", "text")
    total = info.agg(F.sum("size")).first()[0] or 0
    buckets = 1 << max(6, (int(total) // PACK_BYTES).bit_length())
    counts = stored(shared_counts(nodes, buckets).groupBy("node").agg(F.max("n").alias("n"), F.sum("shared").alias("shared")))
    live = _sized(counts.where((F.col("n") > 0) & (DENOMINATOR * F.col("shared") >= NUMERATOR * F.col("n"))).select("node"))
    python_batches(docs.sparkSession)

    def cut(batches):
        hasher = WordHasher()
        for batch in batches:
            sets = _sets(batch.column(1).to_pylist(), hasher)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["node", "n", "hashes"])

    sets = stored(nodes.join(live, "node", "left_semi").mapInArrow(cut, "node long, n long, hashes binary").dropDuplicates(["node"]))
    label = linked(sets).withColumnRenamed("node", "id")
    grouped = info.join(label, info["node"] == label["id"], "left").select("row_key", "doc_id", "node", F.coalesce("label", "node").alias("label"))
    smallest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(smallest, "label").join(counts.select("node", "n"), "node", "left")
    alone = F.coalesce("n", F.lit(0)) == 0
    return named.select("row_key", "doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"),
                        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op10_jaccard(spark, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
