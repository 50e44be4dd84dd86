"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum costs time linear in the
number of features: it is half of (sum v_i x_i)^2 - sum (v_i x_i)^2, added over the factors.
"""

from __future__ import annotations

import io
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled, python_batches, stored, table, texts

WORD = re.compile(r"\w+")
BUCKETS = 1 << 16
FACTORS = 8
BINS = 12  # of each statistic
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
PLAIN = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), 9, 10, 11, 12, 13, 32, 44, 46])
DIGITS = bytes(range(48, 58))
STATISTICS = ("words", "chars", "distinct", "top", "run", "upper", "symbols", "digits", "long", "lines", "triples", "repeated_lines", "ends")
SIZE = BUCKETS + BINS * len(STATISTICS)


def statistics(text: str) -> list[float]:
    """Structure of a text, each value in [0, 1]."""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    without = lambda kept: (len(raw) - len(raw.translate(None, kept))) / size
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    triples = set(zip(words, words[1:], words[2:]))  # noqa: B905
    return [
        min(np.log1p(len(words)) / 12, 1.0), min(np.log1p(len(text)) / 14, 1.0), len(counts) / n,
        max(counts.values(), default=0) / n, sum(map(str.__eq__, words, words[1:])) / n,
        without(UPPER) / max(without(LETTERS), 1e-9), len(raw.translate(None, PLAIN)) / size, without(DIGITS),
        min(size / n / 20, 1.0), min(len(lines) / n * 4, 1.0), len(triples) / max(len(words) - 2, 1),
        1 - len(set(lines)) / max(len(lines), 1), min((text.count(".") + text.count("?")) / n * 4, 1.0)]


class Hasher:
    """Feature numbers and values of texts; word numbers are remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        known, own = self.known, set()
        if len(known) > 400_000:
            known.clear()
        for w in set(WORD.findall(text.lower())):
            k = known.get(w)
            if k is None:
                known[w] = k = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
            own.add(k)
        stats = statistics(text)
        idx = np.fromiter(own, np.int32, len(own))
        idx.sort()  # sums don't depend on the order of a set
        bins = [BUCKETS + BINS * i + min(int(v * BINS), BINS - 1) for i, v in enumerate(stats)]
        values = np.concatenate([np.full(len(idx), 1 / np.sqrt(max(len(idx), 1)), np.float32), np.ones(len(bins), np.float32)])
        return np.concatenate([idx, np.array(bins, np.int32)]), values


def raw_scores(model: dict, idx: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores of rows whose features lie one after the other, row k from starts[k]; no row is empty."""
    vx = model["v"][idx] * x[:, None]
    s = np.add.reduceat(vx, starts)
    q = np.add.reduceat(vx * vx, starts)
    return model["b"] + np.add.reduceat(model["w"][idx] * x, starts) + 0.5 * (s * s - q).sum(1)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 64,
          rate: float = 0.08, decay: float = 2e-5, seed: int = 7) -> dict:
    """Adagrad on the logistic loss; both labels weigh the same in total."""
    rng = np.random.default_rng(seed)
    model = {"b": 0.0, "w": np.zeros(SIZE, np.float32), "v": rng.normal(0, 0.03, (SIZE, FACTORS)).astype(np.float32)}
    gw, gv, gb = np.full(SIZE, 1e-3, np.float32), np.full((SIZE, FACTORS), 1e-3, np.float32), 1e-3
    share = labels.mean()
    weight = np.where(labels > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            idx = np.concatenate([rows[i][0] for i in part])
            x = np.concatenate([rows[i][1] for i in part])
            lengths = np.array([len(rows[i][0]) for i in part])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            vx = model["v"][idx] * x[:, None]
            s = np.add.reduceat(vx, starts)
            y = model["b"] + np.add.reduceat(model["w"][idx] * x, starts) + 0.5 * (s * s - np.add.reduceat(vx * vx, starts)).sum(1)
            g = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[part]) * weight[part] / len(part)
            each = np.repeat(g, lengths) * x
            used, place = np.unique(idx, return_inverse=True)
            dw = np.bincount(place, each, len(used)).astype(np.float32) + decay * model["w"][used]
            grad = each[:, None] * (np.repeat(s, lengths, axis=0) - vx)
            order = np.argsort(place, kind="stable")
            dv = np.add.reduceat(grad[order], np.searchsorted(place[order], np.arange(len(used)))) + decay * model["v"][used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += float(g.sum()) ** 2
            model["w"][used] -= rate * dw / np.sqrt(gw[used])
            model["v"][used] -= rate * dv / np.sqrt(gv[used])
            model["b"] -= rate * float(g.sum()) / np.sqrt(gb)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = 10_000) -> bytes:
    """The model, fitted in one task on labelled documents that aren't held out; ``sample`` bounds them.

    Without labels of both kinds every weight is 0 and every score 0.5.
    """
    rows = stored(labelled(docs, labels, "quality", sample).select("doc_id", "text", "label"))
    python_batches(docs.sparkSession)

    def features(batches):
        hasher = Hasher()
        for batch in batches:
            got = [hasher.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([i.tobytes() for i, _ in got], pa.binary()),
                                              pa.array([v.tobytes() for _, v in got], pa.binary())], names=["doc_id", "label", "idx", "x"])

    def learn(batches):
        got = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[2], r[1]))
        labels = np.array([float(r[1] > 0) for r in got])
        if len(set(labels)) < 2:
            model = {"b": 0.0, "w": np.zeros(SIZE, np.float32), "v": np.zeros((SIZE, FACTORS), np.float32)}
        else:
            model = train([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in got], labels)
        out = io.BytesIO()
        np.savez_compressed(out, **model)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    spread = rows.mapInArrow(features, "doc_id long, label int, idx binary, x binary")
    return bytes(spread.repartition(1).mapInArrow(learn, "model binary").first()[0])


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """row_key, doc_id, score in [0, 1]. Null and empty texts are scored by their statistics."""
    python_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # SIZE * (FACTORS + 1) numbers

    def run(batches):
        loaded = np.load(io.BytesIO(sent.value))
        own, hasher = {"b": float(loaded["b"]), "w": loaded["w"], "v": loaded["v"]}, Hasher()
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [hasher.features(t) for t in batch.column(2).to_pylist()]
            starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in got])[:-1]]).astype(int)
            y = raw_scores(own, np.concatenate([i for i, _ in got]), np.concatenate([v for _, v in got]), starts)
            p = 1 / (1 + np.exp(-np.clip(y.astype(float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], names=["row_key", "doc_id", "score"])

    return texts(docs).select("row_key", "doc_id", "text").mapInArrow(run, "row_key long, doc_id long, score double")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
