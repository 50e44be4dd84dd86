"""Language identification by segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary a probability. A word's probability is the sum over all ways
to cut it into pieces, by a forward algorithm; the piece probabilities come from expected counts over
all cuts (expectation maximisation, each round one Spark aggregation). A text belongs to the language that gives its words
the highest probability.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, held_out, python_batches, stored, table, texts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
RUN = re.compile(r"[^\W\d_]+")
PIECE = 8  # characters of the longest piece that is used
CUT = 32  # letters after which a longer word goes on as another word
UNKNOWN = 1e-7  # probability of a letter that is no piece
ADDED = 0.05  # to every expected count
ROUNDS = 3
BASE = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 20


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Distinct lower-cased pieces of letters, of at most PIECE characters, sorted."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).replace("▁", "").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p.isalpha() and len(p) <= PIECE)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64) + np.uint64(1)


class Pieces:
    """Numbers of pieces by a hash of their letters; number 0 stands for no piece."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces) + 1
        hashes = np.zeros(self.size, np.uint64)
        for length in {len(p) for p in pieces}:
            at = [i + 1 for i, p in enumerate(pieces) if len(p) == length]
            codes, h = _codes([pieces[i - 1] for i in at], length), np.zeros(len(at), np.uint64)
            for k in range(length):
                h = h * BASE + codes[:, k]
            hashes[at] = h
        self.hashes, self.tables, left = hashes, [], np.arange(1, self.size)
        while len(left):  # pieces whose slot is taken go to a further table
            slots, number = self._slots(hashes[left], len(self.tables)), np.zeros(1 << SLOT_BITS, np.int32)
            number[slots[::-1]] = left[::-1]
            left = left[number[slots] != left]
            self.tables.append(number)

    @staticmethod
    def _slots(h: np.ndarray, k: int) -> np.ndarray:
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int32)
        for k, number in enumerate(self.tables):
            got = number[self._slots(h, k)]
            out = np.where((out == 0) & (got > 0) & (self.hashes[got] == h), got, out)
        return out


def _cuts(codes: np.ndarray, pieces: Pieces):
    """(start, stop, piece numbers of all words) of each possible piece place; one letter is always possible."""
    for start in range(codes.shape[1]):
        h = np.zeros(len(codes), np.uint64)
        for stop in range(start + 1, min(start + PIECE, codes.shape[1]) + 1):
            h = h * BASE + codes[:, stop - 1]
            ids = pieces.find(h)
            if stop == start + 1 or ids.any():
                yield start, stop, ids


def word_logs(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """log probability of each word in each language; p[piece, language], p[0] is 0."""
    out = np.zeros((len(words), p.shape[1]))
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        codes = _codes([words[i] for i in at], length)
        alpha = np.zeros((length + 1, len(at), p.shape[1]))
        alpha[0] = 1.0
        for start, stop, ids in _cuts(codes, pieces):
            step = p[ids]
            if stop == start + 1:
                step = np.maximum(step, UNKNOWN)
            alpha[stop] += alpha[start] * step
        out[at] = np.log(alpha[length])
    return out


def expected(words: list[str], times: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, over all cuts of words of one language."""
    total = np.zeros(len(p))
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        cuts = [(a, b, ids, np.maximum(p[ids], UNKNOWN if b == a + 1 else 0.0)) for a, b, ids in _cuts(_codes([words[i] for i in at], length), pieces)]
        alpha, beta = np.zeros((length + 1, len(at))), np.zeros((length + 1, len(at)))
        alpha[0] = beta[length] = 1.0
        for a, b, _, step in cuts:
            alpha[b] += alpha[a] * step
        for a, b, _, step in reversed(cuts):
            beta[a] += step * beta[b]
        weight = times[at] / alpha[length]
        for a, b, ids, step in cuts:
            total += np.bincount(ids, weight * alpha[a] * step * beta[b], len(p))
    total[0] = 0.0
    return total


def split_words(text: str) -> list[str]:
    """Lower-cased runs of letters, cut at CUT letters."""
    found = RUN.findall(text.lower())
    return found if max(map(len, found), default=0) <= CUT else [w[i:i + CUT] for w in found for i in range(0, len(w), CUT)]


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def fit(docs: DataFrame, vocab: list[str] | None = None, sample: int = 8_000) -> dict:
    """Languages and piece probabilities, from documents with a language that aren't held out; ``sample`` bounds them."""
    vocab = vocabulary() if vocab is None else vocab
    spark = docs.sparkSession
    python_batches(spark)
    known = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    known = bounded(known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))), "doc_id", sample)

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((lang, w) for w in split_words(text))
        rows = list(counts.items())
        for i in range(0, len(rows), 50_000):
            part = rows[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in part], pa.string()), pa.array([letters(r[0][1]) for r in part], pa.string()),
                                              pa.array([r[1] for r in part], pa.int64())], names=["lang", "word", "n"])

    words = stored(known.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.length("word") > 0))
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    size = len(vocab) + 1
    p = np.full((size, len(langs)), 1.0 / size)
    p[0] = 0.0
    python_batches(spark, 20_000)
    for _ in range(ROUNDS if langs else 0):
        sent = spark.sparkContext.broadcast((vocab, p))

        def expect(batches, sent=sent, langs=langs):
            vocab, p = sent.value
            pieces = Pieces(vocab)
            total = np.zeros(p.shape)
            for batch in batches:
                part = batch.to_pandas()
                for lang, rows in part.groupby("lang"):
                    k = langs.index(lang)
                    total[:, k] += expected(rows["word"].tolist(), rows["n"].to_numpy(float), pieces, p[:, k])
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[piece, k])], names=["piece", "lang", "n"])

        # pieces of the vocabulary times languages
        sums = words.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full(p.shape, ADDED)
        counts[sums["piece"], sums["lang"]] += sums["n"]
        counts[0] = 0.0
        p = counts / counts.sum(0)
    python_batches(spark)
    return {"langs": langs, "vocab": vocab, "p": p}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """row_key, doc_id, lang_pred, score: the most probable language of each whole text and its share of the probability.

    Null texts and texts without a letter: ``und``, 0. Ties go to the language that is first by code point.
    """
    python_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary times languages

    def run(batches):
        own = sent.value
        pieces, langs, p = Pieces(own["vocab"]), own["langs"], own["p"]
        known: dict[str, int] = {}
        logs = np.zeros((0, len(langs)))
        some = np.zeros(0, bool)  # words with a letter
        for batch in batches:
            lists = [split_words(t or "") for t in batch.column(2).to_pylist()]
            flat = np.array([w for x in lists for w in x], dtype=object)
            codes, unique = pd.factorize(flat)
            if len(known) > 300_000:
                known, logs, some = {}, logs[:0], some[:0]
            new = [w for w in unique if w not in known]
            base = len(known)
            for i, w in enumerate(new):
                known[w] = base + i
            only = [letters(w) for w in new]
            logs = np.concatenate([logs, word_logs(only, pieces, p)]) if new else logs
            some = np.concatenate([some, np.array([bool(w) for w in only], bool)]) if new else some
            at = np.array([known[w] for w in unique], np.int64)[codes] if len(flat) else np.zeros(0, np.int64)
            rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            sums = np.stack([np.bincount(rows, logs[at, k], len(lists)) for k in range(len(langs))], 1) if langs else np.zeros((len(lists), 0))
            any_letter = np.bincount(rows, some[at], len(lists)) > 0
            pred, score = [], []
            for k in range(len(lists)):
                if not langs or not any_letter[k]:
                    pred.append("und")
                    score.append(0.0)
                else:
                    best = int(np.argmax(sums[k]))
                    pred.append(langs[best])
                    score.append(float(1 / np.exp(np.maximum(sums[k] - sums[k, best], -700)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=["row_key", "doc_id", "lang_pred", "score"])

    return texts(docs).select("row_key", "doc_id", "text").mapInArrow(run, "row_key long, doc_id long, lang_pred string, score double")


def op9_language(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
