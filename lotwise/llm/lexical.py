"""Ranked lexical search by trees over items and documents.

Documents are vectors over the items' terms, with a saturated term frequency as coordinate; an item's coordinates are its terms' weights,
and a score is the inner product of the two. Blocks of documents and groups of items are each ordered by their heaviest term and cut
into a small tree whose nodes hold the greatest coordinates of what is below them. The inner product of two nodes bounds all scores
between them, so a pair of nodes whose bound is less than the weakest k-th best score of the items below is left out with all it
holds. A first round scores the most promising leaf of each block, which gives every item a k-th score to begin with; the second
descends from the roots and raises it as it goes. What remains is scored exactly, in integers.

The documents are never shuffled: a task walks the blocks of its own partition and hands out its k best for each item. Items are sent to the tasks
in groups of a bounded number of bytes, one search for each group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

GROUP_BYTES = 16 << 20  # item text that is sent to the tasks at a time
TREE_ITEMS = 512  # items of one tree
BLOCK_DOCS, BLOCK_ENTRIES = 4_096, 2_000_000  # a block ends at the first of the two
DOC_NODES, ITEM_NODES = (256, 16), (16, 4)  # documents, and items, below a node of each level
#: fixed values: what a term is made of, and the numbers of the score
TERM_BREAK = bytes(b for b in range(128) if not chr(b).isalnum())
FOLD = bytes.maketrans(TERM_BREAK + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(TERM_BREAK) + b"abcdefghijklmnopqrstuvwxyz")
NUMERATOR, FREQUENCY, LENGTH, SHARE = 1_000_000_000, 1_000, 12, 25


def terms(text: str | None) -> list[bytes]:
    """Lower-cased terms of a text as UTF-8; only A-Z change."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass
class Sparse:
    """Rows of (term, value) entries; the entries of row i are ``start[i]`` to ``start[i + 1]``, by ascending term."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))

    def taken(self, order: np.ndarray) -> Sparse:
        sizes = np.diff(self.start)[order]
        start = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(start[-1]) + np.repeat(self.start[order] - start[:-1], sizes)
        return Sparse(start, self.term[at], self.value[at])

    def maxima(self, group: np.ndarray, count: int) -> Sparse:
        """Greatest value of each term over the rows of a group; ``group`` numbers the group of each row."""
        width = int(self.term.max(initial=0)) + 1
        key = group[self.rows()] * width + self.term
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        top = np.maximum.reduceat(self.value[order], first) if len(first) else self.value
        return by_row(key[first] // width, key[first] % width, top, count)

    def heaviest(self, weight: np.ndarray) -> np.ndarray:
        """For each row its term of greatest weight times value; -1 for empty rows."""
        out = np.full(len(self), -1, np.int64)
        order = np.lexsort((self.term, -(weight[self.term] * self.value), self.rows()))
        full = np.flatnonzero(np.diff(self.start))
        out[full] = self.term[order[self.start[full]]]
        return out


def by_row(row: np.ndarray, term: np.ndarray, value: np.ndarray, count: int) -> Sparse:
    return Sparse(np.searchsorted(row, np.arange(count + 1)), term, value)


class Tree:
    """Rows ordered by their heaviest term, and nodes over them, level by level from the root down to the rows.

    sizes: rows below a node of each level under the root, each a multiple of the next.
    """

    def __init__(self, rows: Sparse, weight: np.ndarray, sizes: tuple[int, ...]):
        self.order = np.argsort(rows.heaviest(weight), kind="stable")
        self.rows = rows.taken(self.order)
        n = len(rows)
        top = sizes[0] * max(1, -(-n // sizes[0]))
        self.sizes, self.levels = [top, *sizes, 1], [self.rows]
        for below, size in zip(self.sizes[:0:-1], self.sizes[-2::-1], strict=True):
            self.levels.insert(0, self.levels[0].maxima(np.arange(len(self.levels[0])) * below // size, -(-n // size)))

    def children(self, level: int) -> np.ndarray:
        """The node one level up of each node of ``level``."""
        return np.arange(len(self.levels[level])) * self.sizes[level] // self.sizes[level - 1]


class Postings:
    """Rows by term, to multiply with other rows."""

    def __init__(self, rows: Sparse, vocabulary: int):
        order = np.argsort(rows.term, kind="stable")
        self.row, self.value, self.count = rows.rows()[order], rows.value[order], len(rows)
        self.start = np.searchsorted(rows.term[order], np.arange(vocabulary + 1))

    def products(self, docs: Sparse, live: np.ndarray, exact: bool) -> np.ndarray:
        """Inner products (rows here, docs) of the pairs that are live; other pairs get 0. ``exact``: as int64, else as doubles."""
        own = docs.rows()
        some = np.flatnonzero(live.any(0)[own])
        out = np.zeros(self.count * len(docs), np.int64 if exact else float)
        step = 1 << 20
        fan = (self.start[1:] - self.start[:-1])[docs.term[some]]
        ends = np.cumsum(fan)
        at = 0
        while at < len(some):
            stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, side="right")), at + 1)
            part, width = some[at:stop], fan[at:stop]
            if width.sum():
                offset = np.cumsum(width) - width
                posting = np.arange(int(width.sum())) + np.repeat(self.start[docs.term[part]] - offset, width)
                doc, row = np.repeat(own[part], width), self.row[posting]
                kept = live[row, doc]
                pair = (row * len(docs) + doc)[kept]
                amount = self.value[posting][kept] * np.repeat(docs.value[part], width)[kept]
                if exact:
                    np.add.at(out, pair, amount)
                else:
                    out += np.bincount(pair, amount, len(out))
            at = stop
        return out.reshape(self.count, len(docs))


class Items:
    """A group of items as a tree, with the postings of each of its levels."""

    def __init__(self, texts: list[str | None]):
        cut = [terms(t) for t in texts]
        self.words = sorted({w for c in cut for w in c})
        number = {w: i for i, w in enumerate(self.words)}
        counted = [np.unique(np.array([number[w] for w in c], np.int64), return_counts=True) for c in cut]
        empty = np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(cut)), [len(t) for t, _ in counted])
        self.term = np.concatenate([empty, *(t for t, _ in counted)])
        self.times = np.concatenate([empty, *(n for _, n in counted)])
        self.count = len(cut)

    def trees(self, weight: np.ndarray) -> list[tuple[np.ndarray, Tree, list[Postings]]]:
        """The numbers of a few items, their tree, and the postings of its levels."""
        rows, out = by_row(self.row, self.term, self.times * weight[self.term], self.count), []
        for at in range(0, self.count, TREE_ITEMS):
            own = np.arange(at, min(at + TREE_ITEMS, self.count))
            tree = Tree(rows.taken(own), np.ones(len(self.words), np.int64), ITEM_NODES)
            out.append((own, tree, [Postings(level, len(self.words)) for level in tree.levels]))
        return out


def counted(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """doc_id, n (terms), terms and times (arrays): how often each of ``words``, by its number, is in a document."""
    def count(batches):
        number = {w: i for i, w in enumerate(words)}
        for batch in batches:
            sizes, listed, times = [], [], []
            for text in batch.column(1).to_pylist():
                cut = terms(text)
                sizes.append(len(cut))
                own, n = np.unique(np.fromiter((i for i in map(number.get, cut) if i is not None), np.int32), return_counts=True)
                listed.append(own)
                times.append(n)
            arrays = [pa.array(sizes, pa.int64()), pa.array(listed, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n", "terms", "times"])

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
            .mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>"))


def weights(index: DataFrame, total: int, size: int) -> np.ndarray:
    """A term's weight from the number of documents that hold it: floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = F.coalesce(F.col("df"), F.lit(0)).cast("double")
    every = index.sparkSession.range(size).select(F.col("id").cast("int").alias("term"))
    rows = every.join(held, "term", "left").select("term", F.floor(F.log((2.0 * total + 2.0) / (2.0 * df + 1.0)) * 1000.0).alias("w")).collect()  # one group's terms
    out = np.zeros(size, np.int64)
    out[[r["term"] for r in rows]] = [r["w"] for r in rows]
    return out


def coordinates(times: np.ndarray, n: np.ndarray, total: int, length: int) -> np.ndarray:
    """Saturated frequencies of terms that occur ``times`` in documents of ``n`` terms, in integers."""
    m = 100 - SHARE + (SHARE * n * total) // length
    return (NUMERATOR * times) // (FREQUENCY * times + LENGTH * m)


class Best:
    """The k best documents of each item so far; the k-th is the cutoff."""

    def __init__(self, cutoff: np.ndarray, k: int):
        self.cutoff, self.k = cutoff.copy(), k
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in cutoff]  # (-score, no id, id)

    def add(self, item: np.ndarray, score: np.ndarray, docs: list[int | None]) -> None:
        for i in np.unique(item):
            own = item == i
            new = [(-int(s), d is None, d or 0) for s, d in zip(score[own], (docs[j] for j in np.flatnonzero(own)), strict=True)]
            self.found[i] = sorted(self.found[i] + new)[:self.k]
            if len(self.found[i]) == self.k:
                self.cutoff[i] = max(self.cutoff[i], -self.found[i][-1][0])

    def rows(self) -> pd.DataFrame:
        flat = [(i, None if none else d, -s) for i, own in enumerate(self.found) for s, none, d in own]
        frame = pd.DataFrame(flat, columns=["item_no", "doc_id", "score"])
        return frame.astype({"item_no": "int64", "doc_id": "Int64", "score": "int64"})


def score_block(docs: Tree, ids: list[int | None], own: np.ndarray, tree: Tree, postings: list[Postings], best: Best, probe: bool) -> None:
    """One tree of documents against one of items: only the most promising leaf of each item, or by descent from the roots."""
    last = len(docs.levels) - 1
    live = np.ones((len(tree.levels[0]), len(docs.levels[0])), bool)
    if probe:
        bound = postings[-1].products(docs.levels[last - 1], np.ones((len(tree.rows), len(docs.levels[last - 1])), bool), False)
        leaf = np.zeros(bound.shape, bool)
        leaf[np.arange(len(bound)), bound.argmax(1)] = bound.max(1) > 0
        live = leaf[:, docs.children(last)]
    else:
        cutoff = best.cutoff[own][tree.order]
        for level in range(last):
            if level:
                live = live[tree.children(level)][:, docs.children(level)]
            bound = postings[level].products(docs.levels[level], live, False) * (1 + 1e-9)  # sums of doubles
            weakest = np.full(len(tree.levels[level]), np.inf)
            np.minimum.at(weakest, np.arange(len(tree.rows)) // tree.sizes[level], cutoff.astype(float))
            live &= (bound >= weakest[:, None]) & (bound > 0)
            if not live.any():
                return
        live = live[tree.children(last)][:, docs.children(last)]
    score = postings[-1].products(docs.rows, live, True)
    item, doc = np.nonzero(live & (score > 0) & (score >= best.cutoff[own][tree.order][:, None]))
    best.add(own[tree.order[item]], score[item, doc], [ids[i] for i in docs.order[doc]])


def ranked(index: DataFrame, items: Items, weight: np.ndarray, total: int, length: int, k: int, cutoff: np.ndarray, probe: bool) -> DataFrame:
    """item_no, doc_id, score: the k best of each partition for each item, no worse than the item's cutoff."""
    def search(batches):
        trees = items.trees(weight)
        best = Best(cutoff, k)
        held: list[pd.DataFrame] = []

        def close() -> None:
            rows = pd.concat(held)
            sizes = rows["terms"].map(len).to_numpy()
            term, times = (np.concatenate(rows[c].tolist()).astype(np.int64) for c in ("terms", "times"))
            value = coordinates(times, np.repeat(rows["n"].to_numpy(), sizes), total, length)
            block = Sparse(np.concatenate([[0], np.cumsum(sizes)]), term, value)
            ids = [None if pd.isna(i) else int(i) for i in rows["doc_id"]]
            tree = Tree(block, weight, DOC_NODES)
            for own, other, postings in trees:
                score_block(tree, ids, own, other, postings, best, probe)
            held.clear()

        entries = docs = 0
        for part in batches:
            part = part[part["terms"].map(len) > 0]
            ends = part["terms"].map(len).cumsum().to_numpy()
            at = 0
            while at < len(part):
                before = ends[at - 1] if at else 0
                stop = min(at + BLOCK_DOCS - docs, max(at + 1, int(np.searchsorted(ends, before + BLOCK_ENTRIES - entries, side="right"))))
                held.append(part.iloc[at:stop])
                entries, docs, at = entries + ends[stop - 1] - before, docs + stop - at, stop
                if docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES or at < len(part):
                    close()
                    entries = docs = 0
        if held:
            close()
        yield best.rows()

    return index.mapInPandas(search, "item_no long, doc_id long, score long")


def firsts(rows: DataFrame, k: int) -> DataFrame:
    """rank (from 1) of each item's k best, equal scores by ascending id, null ids last."""
    best = W.partitionBy("item_no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _groups(items: DataFrame) -> DataFrame:
    """Distinct items with the number of a group whose texts have GROUP_BYTES, or one item, about."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = items.agg(F.sum(size)).first()[0] or 0
    return items.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-int(total) // GROUP_BYTES)))))


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score, item_text: the k documents with the highest scores above 0 for each item.

    docs: doc_id, text; items: item_id, text; other columns are left behind. Every row of docs is a document, so repeated rows hold neighbouring ranks;
    null ids come last among equal scores. Null and empty texts have no terms and don't count as documents. Items that
    agree in id and text count once; one id with two texts gives two rankings, told apart by item_text. Empty tables give no rows.
    """
    named = stored(_groups(items.select(items["item_id"], items["text"].cast("string").alias("text")).distinct()))
    found = None
    for group in sorted(r["group"] for r in named.select("group").distinct().collect()):
        part = _search_group(docs, named.where(F.col("group") == group).select("item_id", "text"), k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kinds = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long, item_text string"
        return docs.sparkSession.createDataFrame([], kinds)
    return found


def _search_group(docs: DataFrame, own: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = sorted(own.collect(), key=lambda r: (str(r["item_id"]), r["text"] or ""))  # GROUP_BYTES at most, but for one larger item
    items = Items([r["text"] for r in rows])
    index = stored(counted(docs, items.words))
    total, length = index.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    weight = weights(index, total, len(items.words))
    start = np.zeros(len(rows), np.int64)
    place = F.row_number().over(W.partitionBy("item_no").orderBy(F.desc("score")))
    probed = ranked(index, items, weight, total, length or 1, k, start, True)
    for r in probed.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).select("item_no", "score").collect():
        start[r["item_no"]] = r["score"]
    best = firsts(ranked(index, items, weight, total, length or 1, k, start, False), k)
    schema = own.schema.add("item_no", "long")
    names = spark.createDataFrame([(r["item_id"], r["text"], i) for i, r in enumerate(rows)], schema)
    return names.join(best, "item_no").select("item_id", "rank", "doc_id", "score", F.col("text").alias("item_text"))


def op12_lexical(spark, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")
