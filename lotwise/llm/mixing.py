"""Mixing sources to target weights by entropy balancing.

Document rates w stay as close to 1 in relative entropy as the token constraints allow:
minimise sum(w ln w - w + 1) with sum(w * size) = target in each source and w <= 3. The solution is an
exponential tilt, w = min(3, exp(t * size / scale)), with one dual variable t per source; Newton steps
on the convex dual find it. The sums that a step needs depend on sizes only, so documents are counted
once by (source, size) and the steps run on those counts. Rates are then rounded to whole copies.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, stored

MOST = 3  # copies of a document, and target over size of a source
WEIGHTS = (1, 2, 3)  # of the sources by code point, repeating
BUCKETS = 1 << 12
NEWTON_STEPS = 60
TOLERANCE = 1e-9


def targets(sizes: DataFrame, most: float = MOST) -> DataFrame:
    """Token target of each source from its size; null sources are one source, the last.

    sizes: source, source_size. Weights repeat 1, 2, 3 by code point. Shares add up to all tokens; a
    source stops at ``most`` times its size and its excess goes to the others by weight. Filling
    up in the order of size over weight gives the fixed point of that in one pass: sources up to some
    place in this order are full, those behind it share the rest. One row per source is
    numbered in one window, which is the size of the list of sources, not of the corpus.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = sizes.withColumn("weight", F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("double"))
    fill = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    full = most * F.col("source_size") <= F.col("level") * F.col("weight")
    ranked = weighed.withColumn("level", level).withColumn("full", full)
    # the level of the first source that isn't full holds for all behind it
    rest = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(every)
    return ranked.withColumn("rest", rest).select(
        "source", "source_size",
        F.when(F.col("full"), most * F.col("source_size").cast("double"))
        .otherwise(F.col("rest") * F.col("weight")).alias("target"))


def tilts(counts: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """Dual variable and scale of each source: source, t, scale.

    counts: source, size, docs. Newton steps start at t = 0 and are kept inside a bracket that every
    step narrows, so they also converge where the cap on rates makes the curve flat. All sources are
    stepped together until the largest relative error is below TOLERANCE.
    """
    size, docs = F.col("size"), F.col("docs")
    scale = counts.where(size > 0).groupBy("source").agg((F.sum(size * size * docs) / F.sum(size * docs)).alias("scale"))
    null_safe = lambda a, b: a["source"].eqNullSafe(b["source"])
    state = goals.join(scale, null_safe(goals, scale)).select(
        goals["source"], "target", "source_size", "scale", F.lit(0.0).alias("t"),
        F.lit(-1.0e6).alias("low"), F.lit(1.0e6).alias("high"))
    state = stored(state.where(F.col("target") < most * F.col("source_size")))
    for _ in range(NEWTON_STEPS):
        tilt = F.exp(F.least(F.col("t") * size / F.col("scale"), F.lit(50.0)))
        rows = counts.join(state, null_safe(counts, state)).select(state["*"], size, docs, tilt.alias("tilt"))
        stepped = rows.groupBy(*state.columns).agg(
            F.sum(docs * size * F.least("tilt", F.lit(float(most)))).alias("got"),
            F.sum(F.when(F.col("tilt") < most, docs * size * size / F.col("scale") * F.col("tilt")).otherwise(0.0)).alias("slope"))
        high = F.when(F.col("got") > F.col("target"), F.col("t")).otherwise(F.col("high"))
        low = F.when(F.col("got") <= F.col("target"), F.col("t")).otherwise(F.col("low"))
        newton = F.col("t") + (F.col("target") - F.col("got")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        error = F.abs(F.col("got") - F.col("target")) / F.col("target")
        # outside the bracket: halve it, on a scale that reaches its far ends in few steps
        middle = F.sinh((F.asinh("low") + F.asinh("high")) / 2)
        state = stored(stepped.withColumns({"low": low, "high": high}).select(
            "source", "target", "source_size", "scale",
            F.when(error < TOLERANCE, F.col("t")).when(inside, newton).otherwise(middle).alias("t"),
            "low", "high", error.alias("error")))
        if (state.agg(F.max("error")).first()[0] or 0.0) < TOLERANCE:
            break
        state = state.drop("error")
    return state.select("source", "t", "scale")


def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Copies of each document: row_key, doc_id, size, source_size, target, rate, copies.

    Size is the number of words; null text: 0. Documents without words get no copy. Whole copies
    below the rate are taken first. Of the fractions, a source takes one more copy of documents in
    the order of hash / fraction while they fit its target, and at last two documents whose sizes come
    nearest to what is missing. Running sums have two levels, buckets first and then the one bucket that
    crosses, so no task orders a whole source. Ties of repeated rows are broken by their place;
    such rows are alike, so reruns return the same rows whatever the partitions are.
    """
    source = docs["source"].cast("string")
    size = F.coalesce(F.regexp_count(docs["text"].cast("string"), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")
    rows = stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), source.alias("source"), size.alias("size"),
                              F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"), source).alias("row_key"),
                              F.monotonically_increasing_id().alias("row_id")))
    counts = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goals = stored(targets(sizes, most))
    tilt = tilts(counts, goals, most)
    per_source = goals.join(tilt, goals["source"].eqNullSafe(tilt["source"]), "left").select(goals["*"], "t", "scale")
    per_source = stored(per_source)
    joined = rows.join(per_source, rows["source"].eqNullSafe(per_source["source"])).select(rows["*"], "source_size", "target", "t", "scale")
    rate = (F.when(F.col("size") == 0, 0.0).when(F.col("t").isNull(), float(most))
            .otherwise(F.least(F.exp(F.least(F.col("t") * F.col("size") / F.col("scale"), F.lit(50.0))), F.lit(float(most)))))
    draw = (F.shiftrightunsigned(F.xxhash64("row_key", F.lit("mix")), 11) + 1) / float(1 << 53)
    rated = (joined.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("long"))
             .withColumn("fraction", F.col("rate") - F.col("whole"))
             .withColumn("turn", F.when(F.col("fraction") > 0, draw / F.col("fraction")))
             .withColumn("bucket", F.least(F.floor(F.col("turn") * (BUCKETS // 4)), F.lit(BUCKETS - 1)).cast("int")))
    by_bucket = rated.groupBy("source", "bucket", "target").agg(
        F.sum(F.col("size") * F.col("whole")).alias("sure"),
        F.sum(F.when(F.col("turn").isNotNull(), F.col("size")).otherwise(0)).alias("more"))
    source_window = W.partitionBy("source")
    running = source_window.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    marks = (by_bucket.withColumn("room", F.col("target") - F.sum("sure").over(source_window))
             .withColumn("before", F.coalesce(F.sum("more").over(running), F.lit(0)))
             .where(F.col("bucket").isNotNull())
             .withColumn("crosses", (F.col("before") < F.col("room")) & (F.col("before") + F.col("more") > F.col("room"))))
    marks = stored(marks.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "room", "before", "more", "crosses"))
    # buckets wholly taken are a range per source; one more bucket, at most, is taken in part
    limit = marks.groupBy("_source").agg(
        F.max(F.when(F.col("before") + F.col("more") <= F.col("room"), F.col("_bucket"))).alias("last_full"),
        F.max(F.when(F.col("crosses"), F.col("_bucket"))).alias("cut"),
        F.max(F.when(F.col("crosses"), F.col("room") - F.col("before"))).alias("left"))
    placed = rated.join(limit, rated["source"].eqNullSafe(limit["_source"]), "left").drop("_source")
    inside = placed.where(F.col("bucket") == F.col("cut"))
    order = W.partitionBy("source").orderBy("turn", "row_key", "row_id")
    upto = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    taken = inside.withColumn("upto", upto).where(F.col("upto") <= F.col("left"))
    last = taken.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("turn", "row_key", "row_id")).alias("last"))
    chosen = placed.join(last, placed["source"].eqNullSafe(last["_source"]), "left").drop("_source")
    extra = (F.col("bucket") <= F.col("last_full")) | (
        (F.col("bucket") == F.col("cut")) & (F.struct("turn", "row_key", "row_id") <= F.col("last")))
    chosen = stored(chosen.withColumn("copies", F.col("whole") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0))
                    .select("row_key", "row_id", "doc_id", "source", "size", "source_size", "target", "rate",
                            F.col("copies").cast("long").alias("copies")))
    chosen = stored(one_more(chosen, most, F.col("size") <= F.col("gap")))
    return one_more(chosen, most, F.lit(True)).drop("row_id")


def one_more(chosen: DataFrame, most: int, fits: Column) -> DataFrame:
    """One more copy, in each source, of the document whose size is nearest to what is still missing."""
    gap = chosen.groupBy(F.col("source").alias("_source")).agg(
        (F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap"))
    near = F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "row_key", "row_id")
    best = (chosen.where((F.col("copies") < most) & (F.col("size") > 0))
            .join(gap, chosen["source"].eqNullSafe(gap["_source"])).where(fits)
            .groupBy("_source", "gap").agg(F.min(near).alias("best"))
            .where(F.col("best.off") < F.col("gap"))
            .select("_source", F.col("best.row_key").alias("_key"), F.col("best.row_id").alias("_id")))
    final = chosen.join(best, chosen["source"].eqNullSafe(best["_source"]) & (F.col("row_key") == F.col("_key"))
                        & (F.col("row_id") == F.col("_id")), "left")
    copies = F.col("copies") + F.when(F.col("_id").isNotNull(), 1).otherwise(0)
    return final.select("row_key", "row_id", "doc_id", "source", "size", "source_size", "target", "rate",
                        copies.cast("long").alias("copies"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Words taken of each document by the mix of all sources."""
    from .common import table

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
