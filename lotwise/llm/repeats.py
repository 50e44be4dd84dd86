"""Substring deduplication by recompression.

Words are names; each round replaces pairs of names by new ones. A name's hash puts it on the left or the right side,
and a left name followed by a right one becomes the hash of both, the same everywhere in the corpus and on every executor, so a round needs no
exchange. A pair depends on its two names only, so equal texts get equal names but for a margin of 2^r - 1 words at each
end after r rounds. (A run of one name lies on one side and stays: where a cut of it into blocks falls
would depend on its far end.) Each window of 50 words chooses the longest pair of third-round names inside its margins; windows that are equal choose
equally. Names that several documents hold reveal the places where windows can repeat, and only those windows are
compared, by 96-bit hashes of all their words.

Names and windows travel packed: a row holds those of a batch of documents that fall into one hash range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_batches, stored, table, texts
from .wordhash import BASE, WordHasher, mix

WINDOW = 50
ROUNDS = 3
MARGIN = (1 << ROUNDS) - 1
LONGEST = 2 << ROUNDS  # words of a pair of names, at most
STARTS = WINDOW - 2 * MARGIN - LONGEST + 1  # places where a pair inside the margins can begin
PACK_BYTES = 16 << 20  # text per hash range
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
ENTRY = np.dtype([("key", np.uint64), ("check", np.uint32), ("at", np.int32), ("place", np.uint8)])


def recompress(names: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Names after some rounds, and the word where each begins."""
    at = np.arange(len(names))
    for r in range(rounds):
        side = mix(names + np.uint64(r + 1)) >> np.uint64(63)
        pair = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1))
        names = names.copy()
        names[pair] = mix(names[pair] * BASE + names[pair + 1])
        keep = np.ones(len(names), bool)
        keep[pair + 1] = False
        names, at = names[keep], at[keep]
    return names, at


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names that the windows of a document choose, and the words where they begin."""
    n = len(words)
    if n < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    names, at = recompress(words)
    key = mix(names[:-1] * BASE + names[1:])
    span = np.append(at[2:], n) - at[:-1]
    weight = np.zeros(n, np.uint64)
    weight[at[:-1]] = (span.astype(np.uint64) << np.uint64(56)) | (key >> np.uint64(8))
    own = np.zeros(n, np.uint64)
    own[at[:-1]] = key
    choice = sliding_window_view(weight[MARGIN:n - WINDOW + MARGIN + STARTS], STARTS).argmax(1)
    chosen = np.unique(np.arange(n - WINDOW + 1) + MARGIN + choice)
    return own[chosen], chosen.astype(np.int32)


def _rolled(words: np.ndarray) -> np.ndarray:
    """Hash of each run of WINDOW words, from sums of words times falling powers."""
    n = len(words)
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, INVERSE)]), dtype=np.uint64)
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - WINDOW, BASE)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * down, dtype=np.uint64)])
    return mix((sums[WINDOW:] - sums[:-WINDOW]) * up)


def windows(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (64 and 32 bits) and starts of the windows that may have chosen an anchor at one of ``places``."""
    last = len(words) - WINDOW
    marked = np.zeros(last + 2, np.int64)
    np.add.at(marked, np.clip(places - MARGIN - STARTS + 1, 0, last + 1), 1)
    np.add.at(marked, np.clip(places - MARGIN + 1, 0, last + 1), -1)
    starts = np.flatnonzero(np.cumsum(marked)[:-1] > 0)
    return _rolled(words)[starts], (_rolled(mix(words + BASE))[starts] >> np.uint64(32)).astype(np.uint32), starts.astype(np.int32)


def _packed(rows: DataFrame, emit, buckets: int) -> DataFrame:
    """One row per hash range and batch of documents. emit(hasher, text, further columns) gives keys, checks and places of a text."""
    bits = buckets.bit_length() - 1
    python_batches(rows.sparkSession, 250)  # a byte numbers the documents of a batch

    def pack(batches):
        hasher = WordHasher()
        for batch in batches:
            parts = []
            for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                key, check, at = emit(hasher, *row)
                part = np.zeros(len(key), ENTRY)
                part["key"], part["check"], part["at"], part["place"] = key, check, at, i
                parts.append(part)
            if not parts:
                continue
            every = np.concatenate(parts)
            every = every[np.argsort(every["key"])]
            edges = np.searchsorted(every["key"] >> np.uint64(64 - bits), np.arange(buckets + 1, dtype=np.uint64))
            keys = np.array(batch.column(0).to_pylist(), np.int64).tobytes()
            ids = np.array([np.iinfo(np.int64).max if x is None else x for x in batch.column(1).to_pylist()], np.int64).tobytes()
            full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([keys] * len(full), pa.binary()), pa.array([ids] * len(full), pa.binary()),
                pa.array([every[edges[b]:edges[b + 1]].tobytes() for b in full], pa.binary())], names=["bucket", "keys", "ids", "entries"])

    return rows.mapInArrow(pack, "bucket int, keys binary, ids binary, entries binary")


def _repeated(packed: DataFrame, later: bool) -> DataFrame:
    """row_key, places (array<binary> of int32): entries that other documents hold too; ``later``: documents with a smaller id.

    A hash range is one group; its size is bounded by the number of ranges, and a key that many documents hold adds one entry for each of them.
    """
    def match(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(e, ENTRY) for e in rows["entries"]]
        every = np.concatenate(parts)
        ids = np.concatenate([np.frombuffer(i, np.int64)[p["place"]] for i, p in zip(rows["ids"], parts, strict=True)])
        order = np.lexsort((every["check"], every["key"]))
        key, check = every["key"][order], every["check"][order]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        low = np.minimum.reduceat(ids[order], first)
        if later:
            hit = ids[order] > low[group]
        else:
            hit = (np.maximum.reduceat(ids[order], first) > low)[group]
        flags = np.zeros(len(every), bool)
        flags[order[hit]] = True
        out_keys, out_places, at = [], [], 0
        for keys, part in zip(rows["keys"], parts, strict=True):
            own = part[flags[at:at + len(part)]]
            at += len(part)
            if len(own):
                names = np.frombuffer(keys, np.int64)
                own = own[np.argsort(own["place"], kind="stable")]
                cut = np.flatnonzero(np.diff(own["place"], prepend=-1))
                out_keys += [names[p] for p in own["place"][cut]]
                out_places += [x.tobytes() for x in np.split(np.ascontiguousarray(own["at"]), cut[1:])]
        return pd.DataFrame({"row_key": np.array(out_keys, np.int64), "places": out_places})

    found = packed.groupBy("bucket").applyInPandas(match, "row_key long, places binary")
    return found.groupBy("row_key").agg(F.collect_list("places").alias("places"))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _joined(places: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(places or []), np.int32)


def repeats(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, n_words, n_removed, kept (text: the words left, joined by one space) of every row.

    A word goes if a window of 50 words that covers it also starts in a document with a smaller id. Null and empty texts have no words. A null
    id counts as larger than any other. Rows of equal id and text are one document. Of equal
    texts only the one with the smallest id is searched; the others go whole, if they have 50 words.
    """
    rows = texts(docs)
    keyed = rows.select("row_key", "doc_id", "text", F.xxhash64("text", F.lit("node")).alias("node"))
    info = stored(keyed.select("row_key", "doc_id", "node", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")))
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    least = info.groupBy("node").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = stored(info.join(least, "node").where(order > F.col("least")).select("row_key").distinct())
    first = rows.join(copies, "row_key", "left_anti").select("row_key", "doc_id", "text")
    total = info.agg(F.sum("size")).first()[0] or 0
    buckets = 1 << max(6, (int(total) // PACK_BYTES).bit_length())

    def name(hasher, text):
        key, at = anchors(hasher(_words(text)))
        return key, np.uint32(0), at

    shared = stored(_repeated(_packed(first, name, buckets), later=False))

    def window(hasher, text, places):
        key, check, at = windows(hasher(_words(text)), _joined(places))
        return key, check, at

    covered = stored(_repeated(_packed(first.join(shared, "row_key"), window, buckets), later=True))
    marks = covered.select("row_key", "places", F.lit(False).alias("copy")).unionByName(
        copies.select("row_key", F.lit(None).cast("array<binary>").alias("places"), F.lit(True).alias("copy")))
    python_batches(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, places, copy in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                words = _words(text)
                gone = np.zeros(len(words) + 1, np.int64)
                starts = _joined(places)
                if copy and len(words) >= WINDOW:
                    starts = np.arange(len(words) - WINDOW + 1)
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + WINDOW, -1)
                gone = np.cumsum(gone)[:-1] > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if n_removed[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())],
                                             names=["row_key", "doc_id", "n_words", "n_removed", "kept"])

    whole = rows.join(marks, "row_key", "left").select("row_key", "doc_id", "text", "places", "copy")
    return whole.mapInArrow(cut, "row_key long, doc_id long, n_words long, n_removed long, kept string")


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    """Words left in every document once repeated windows of 50 words are gone."""
    return repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
