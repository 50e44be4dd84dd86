"""Benchmark decontamination by a positional inverted index.

Postings (term, document, position) are kept for every corpus token whose term some benchmark
item holds. A benchmark window is looked up from its rarest terms: the list of the rarest is shifted by
the term's offset and intersected with the shifted list of the second rarest; what is left is a possible start
of the window, and all its words are then compared in place. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, texts

WINDOW = 13
NEAR = 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: fixed value: what separates words, after A-Z are lower-cased
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words as array<string>; null text: none."""
    lower = F.translate(text, UPPER, LOWER)
    return F.coalesce(F.array_remove(F.split(lower, BREAK), ""), F.array().cast("array<string>"))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: window_id, terms (array), item_ids (array, sorted as strings).

    An item of fewer words, but not none, is one window. Null ids count as one item named ''.
    """
    rows = items.select(F.coalesce(items["item_id"].cast("string"), F.lit("")).alias("item_id"),
                        words(items["text"].cast("string")).alias("terms")).where(F.size("terms") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - size + 1, F.lit(1)))
    cut = rows.select("item_id", "terms", F.explode(starts).alias("at")).select(
        "item_id", F.slice("terms", F.col("at"), F.lit(size)).alias("terms"))
    return cut.groupBy("terms").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")).select(
        F.xxhash64("terms").alias("window_id"), "terms", "item_ids")


def postings(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The index: term, row_key, position (from 0) of each corpus token whose term is wanted.

    The list of terms has the size of the benchmark's vocabulary; Spark broadcasts it where its real
    size allows and shuffles both sides otherwise.
    """
    tokens = rows.select("row_key", F.posexplode(words(F.col("text"))).alias("position", "term"))
    return tokens.join(wanted, "term", "left_semi")


def rarest(cut: DataFrame, frequency: DataFrame, most: int = 2) -> DataFrame:
    """The rarest terms of each window: window_id, and the first ``most`` as t1, o1, t2, o2 ...

    Rarity is the number of postings (none: the window can't occur and is left out). A window of equal
    terms only has one; its t2 is null.
    """
    terms = cut.select("window_id", F.posexplode("terms").alias("offset", "term"))
    first = terms.groupBy("window_id", "term").agg(F.min("offset").alias("offset"))
    counted = first.join(frequency, "term", "left")
    ordered = counted.groupBy("window_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("r"))  # one window's terms
    kept = ordered.where(F.col("r")[0]["n"] > 0)
    columns = []
    for k in range(most):
        pick = F.get("r", F.lit(k))
        columns += [pick["term"].alias(f"t{k + 1}"), pick["offset"].alias(f"o{k + 1}")]
    return kept.select("window_id", *columns)


def intersected(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Possible starts (row_key, start, window_id): postings of t1 and of t2 at fitting places.

    Windows of one item share their rarest term; they are looked up once by (term pair, distance).
    """
    pairs = anchors.select("t1", "t2", (F.col("o2") - F.col("o1")).alias("apart")).distinct()
    one = index.join(pairs, index["term"] == pairs["t1"]).select(
        "row_key", "position", "t1", "t2", "apart", (F.col("position") + F.coalesce("apart", F.lit(0))).alias("at2"))
    second = index.join(pairs.select("t2").distinct(), index["term"] == F.col("t2"), "left_semi").select(
        F.col("row_key").alias("_key"), F.col("position").alias("_position"), F.col("term").alias("_term"))
    alone = one.where(F.col("t2").isNull())
    met = one.where(F.col("t2").isNotNull()).join(
        second, (one["row_key"] == second["_key"]) & (one["at2"] == second["_position"]) & (one["t2"] == second["_term"]), "left_semi")
    both = met.unionByName(alone)
    named = anchors.select("window_id", "o1", F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), (F.col("o2") - F.col("o1")).alias("_apart"))
    return (both.join(named, (both["t1"] == named["_t1"]) & both["t2"].eqNullSafe(named["_t2"])
                      & both["apart"].eqNullSafe(named["_apart"]))
            .select("row_key", (F.col("position") - F.col("o1")).alias("start"), "window_id")
            .where(F.col("start") >= 0))


def phrase_matches(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every occurrence of a window: row_key, start, length, item_ids."""
    return _matched(texts(docs), items, size)[0]


def _matched(rows: DataFrame, items: DataFrame, size: int):
    cut = stored(windows(items, size))
    wanted = cut.select(F.explode("terms").alias("term")).distinct()
    index = stored(postings(rows, wanted))
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    anchors = stored(rarest(cut, frequency))
    starts = intersected(index, anchors).distinct()
    # compare all words in place; only documents with a possible start are looked at
    possible = starts.join(cut, "window_id").groupBy("row_key").agg(
        F.collect_list(F.struct("start", "terms", "item_ids")).alias("possible"))
    found = (rows.select("row_key", "text").join(possible, "row_key")
             .select("row_key", "possible", words(F.col("text")).alias("words"))
             .select("row_key", F.filter("possible", lambda c: F.slice("words", c["start"] + 1, F.size(c["terms"])) == c["terms"])
                     .alias("true")))
    occurrences = found.select("row_key", F.explode("true").alias("m")).select(
        "row_key", F.col("m.start").alias("start"), F.size("m.terms").alias("length"), F.col("m.item_ids").alias("item_ids"))
    return occurrences, index, cut, frequency


def proximity_matches(docs: DataFrame, items: DataFrame, near: int = NEAR, terms: int = 2) -> DataFrame:
    """Items whose rarest terms stand within ``near`` words of each other, in any order.

    Returns row_key, item_id and the least distance. The index is joined with itself by document and by blocks of
    ``near`` positions, each posting of the rarest term being sent to its own block and both neighbours.
    """
    rows = texts(docs)
    whole = stored(windows(items, 1 << 30))
    index = stored(postings(rows, whole.select(F.explode("terms").alias("term")).distinct()))
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    anchors = rarest(whole, frequency, terms).where(F.col(f"t{terms}").isNotNull())
    block = F.floor(F.col("position") / near)
    first = index.join(anchors.select("window_id", "t1", "t2"), index["term"] == F.col("t1")).select(
        "row_key", "window_id", "t2", F.col("position").alias("p1"),
        F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    second = index.join(anchors.select("t2").distinct(), index["term"] == F.col("t2"), "left_semi").select(
        "row_key", F.col("term").alias("t2"), F.col("position").alias("p2"), block.alias("block"))
    close = first.join(second, ["row_key", "t2", "block"]).withColumn("apart", F.abs(F.col("p2") - F.col("p1"))).where(F.col("apart") <= near)
    return (close.groupBy("row_key", "window_id").agg(F.min("apart").alias("apart"))
            .join(whole.select("window_id", F.explode("item_ids").alias("item_id")), "window_id")
            .groupBy("row_key", "item_id").agg(F.min("apart").alias("apart")))


def covered(spans: Column) -> Column:
    """Number of positions inside an array of struct<start, stop> that is sorted by start."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, m: F.struct(
        (acc["n"] + F.greatest(m["stop"] - F.greatest(m["start"], acc["upto"]), F.lit(0))).alias("n"),
        F.greatest(acc["upto"], m["stop"]).alias("upto"))
    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row: row_key, doc_id, n_words, n_hit, item_ids (array of strings), contaminated.

    Null or empty texts have no words and are not contaminated. Repeated rows get equal results.
    Contaminated: at least one word in twenty is inside an occurring window.
    """
    rows = texts(docs)
    occurrences = stored(_matched(rows, items, size)[0])
    spans = occurrences.groupBy("row_key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("stop")))).alias("spans"))
    named = (occurrences.select("row_key", F.explode("item_ids").alias("item_id")).distinct()
             .groupBy("row_key").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids")))
    hits = spans.join(named, "row_key").select("row_key", covered(F.col("spans")).alias("n_hit"), "item_ids")
    counted = rows.select("row_key", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return counted.join(hits, "row_key", "left").select(
        "row_key", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def op6_contamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    from .common import table

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
