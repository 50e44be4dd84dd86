"""Periodic runs of words, found by seeds that are extended along diagonals.

A run with period q of at least four periods is a stretch where word i equals word i + q: a stretch on diagonal q of at least 3 q
matches. Lags are searched in bands [1], [2, 3], [4, 7] ...: the least overlap that a run of the band guarantees is the size of the word
k-grams that are indexed for it. As that is no less than any lag of the band but one, a k-gram inside a run comes again after exactly one
period and not sooner, so only next occurrences in the same document are paired, never all occurrences with each other. Each pair seeds an
extension along its diagonal, unless the table of furthest covered places says that the lag has been covered there. A k-gram that
does not come again leaves no longer one that does, so each band looks only at what the one before has left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, texts
from .wordhash import BASE, mix

LEAST, TIMES = 6, 4  # words, and periods, that a run has at least
SLICE_BYTES = 4 << 20  # text that is searched at a time
SCHEMA = "row_key long, doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string"


class Names(dict):
    """Numbers words in order of their first appearance; equal numbers mean equal words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def overlap(lags: range, least: int = LEAST, times: int = TIMES) -> int:
    """Matches that a run of any of these periods, or of a longer one, has on its diagonal at least."""
    return min(max(least, times * q) - q for q in range(lags[0], max(lags[-1], least) + 1))


def grown(grams: np.ndarray, at: np.ndarray, live: np.ndarray, size: int, wanted: int) -> np.ndarray:
    """Names of longer word sequences at places ``at``, from names of ``size`` words; zero where they can't come again.

    A sequence of up to twice the size is named by the names at its first and its last place.
    """
    while size < wanted:
        longer = min(wanted, 2 * size)
        last = at + (longer - size)
        inside = last < len(grams)
        inside[inside] = live[last[inside]]
        at, last = at[inside], last[inside]
        named = mix(grams[at] * BASE + mix(grams[last] + np.uint64(longer)))
        grams, live = np.zeros_like(grams), np.zeros_like(live)
        grams[at], live[at] = named, True
        size = longer
    return grams


def extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The stretch [start, stop) around ``place`` where each word equals the one ``lag`` words on."""
    stop, size = place, 64
    while stop + lag < len(words):
        most = min(size, len(words) - lag - stop)
        same = words[stop:stop + most] == words[stop + lag:stop + lag + most]
        reach = most if same.all() else int(same.argmin())
        stop += reach
        if reach < most:
            break
        size *= 2
    start, size = place, 64
    while start > 0:
        most = min(size, start)
        same = (words[start - most:start] == words[start + lag - most:start + lag])[::-1]
        reach = most if same.all() else int(same.argmin())
        start -= reach
        if reach < most:
            break
        size *= 2
    return start, stop


def runs_of(words: np.ndarray, salt: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted by start and period.

    words: numbers; those that end a document are unique. salt: a number for each place, that of its document, so
    that sequences are paired inside documents only. At least three periods are needed for next occurrences to be enough.
    """
    if times < 3:
        raise ValueError("a run needs three periods at least")
    found, furthest = [], {}
    lags, size = range(1, 2), 1
    grams = mix(words.astype(np.uint64) + mix(salt.astype(np.uint64) + BASE))
    live = np.ones(len(words), bool)
    while True:
        wanted = overlap(lags, least, times)
        at = np.flatnonzero(live)
        grams, size = grown(grams, at, live, size, wanted), max(size, wanted)
        at = np.flatnonzero(grams)
        order = at[np.argsort(grams[at], kind="stable")]
        again = grams[order][1:] == grams[order][:-1]
        first, lag = order[:-1][again], np.diff(order)[again]
        seeds = (lag >= lags[0]) & (lag <= lags[-1])
        by_place = np.argsort(first[seeds], kind="stable")
        for place, step in zip(first[seeds][by_place].tolist(), lag[seeds][by_place].tolist(), strict=True):
            if place < furthest.get(step, -1):
                continue
            start, stop = extended(words, place, step)
            furthest[step] = stop
            length = stop - start + step
            if length >= max(least, times * step):
                found.append((start, length, step))
        live = np.zeros(len(words), bool)
        live[first] = live[order[1:][again]] = True
        lags = range(2 * lags[0], 4 * lags[0])
        if not live.any() or times * lags[0] > len(words):
            return sorted((s, n, q) for s, n, q in found)


def repeated_places(size: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for words inside a run, after that run's first period."""
    edges = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:-1] > 0


def _found(texts_: list[str | None]) -> tuple[list[int], list[list[dict]], list[str]]:
    """Numbers of words, runs, and what is kept, of a few documents that are searched together."""
    names = Names()
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts_]
    sizes = np.array([len(w) for w in split], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.empty(int(offsets[-1]), np.int64)
    for i, w in enumerate(split):
        words[offsets[i]:offsets[i] + len(w)] = np.fromiter(map(names.__getitem__, w), np.int64, len(w))
        words[offsets[i + 1] - 1] = -1 - i
    by_doc: list[list[tuple[int, int, int]]] = [[] for _ in split]
    if len(words):
        for start, length, period in runs_of(words, np.repeat(np.arange(len(split)), sizes + 1)):
            doc = int(np.searchsorted(offsets, start, side="right")) - 1
            by_doc[doc].append((start - int(offsets[doc]), length, period))
    kept = []
    for w, own in zip(split, by_doc, strict=True):
        if own:
            w = [x for x, gone in zip(w, repeated_places(len(w), own).tolist(), strict=True) if not gone]
        kept.append(b" ".join(w).decode("utf-8", "surrogatepass"))
    listed = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in by_doc]
    return sizes.tolist(), listed, kept


def periodic_runs(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, n_words, runs (array<struct<start, length, period>>) and kept (text) of every row; no shuffle.

    A run is a stretch of words with smallest period q, of max(6, 4 q) words at least, that neither neighbour extends. Runs are sorted by
    start and period; starts count words from 0. kept: words outside runs and the first period of each run, joined by one
    space. Null and empty texts have no words, no runs, and an empty kept text. Repeated rows get equal results; a table without
    rows gives none. Names of word sequences are 64-bit hashes; every run is confirmed word by word.
    """
    def search(batches):
        for batch in batches:
            column = batch.column(2).to_pylist()
            start = 0
            while start < len(column):
                stop, held = start, 0
                while stop < len(column) and (stop == start or held + len(column[stop] or "") <= SLICE_BYTES):
                    held += len(column[stop] or "")
                    stop += 1
                n_words, runs, kept = _found(column[start:stop])
                size = stop - start
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, size), batch.column(1).slice(start, size), pa.array(n_words, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                     pa.array(kept, pa.string())], names=["row_key", "doc_id", "n_words", "runs", "kept"])
                start = stop

    return texts(docs).select("row_key", "doc_id", "text").mapInArrow(search, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as exact fractions; the first of equals. Null without runs."""
    kind = "struct<start:long,length:long,period:long>"
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(kind), lambda best, r: F.when(better(best, r), r).otherwise(best))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The documents of the contract: of a tenth of them (by crc32 of the id) the words from some place on repeat a short stretch."""
    h = F.crc32(docs["doc_id"].cast("long").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split(docs["text"].cast("string"), r"[\x20\x09-\x0D]+"), "")
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), g.alias("g"),
                         F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    at = chosen.withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    period = F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1
    at = at.withColumn("p", period.cast("int")).withColumn("a", F.col("a").cast("int"))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    whole = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return at.select("doc_id", F.when(F.col("n") > 0, whole).otherwise(F.col("text")).alias("text"))


def op11_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which get periodic tails first."""
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), strongest(F.col("runs")).alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
    milli = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
