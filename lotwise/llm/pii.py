"""Personal data: format rules, and a character-level bidirectional LSTM with CRF transitions.

The rules label spans of a bounded sample of documents; the network learns them in numpy, together with other ways of
writing the same values, which no rule matches: spelled-out and bracketed signs, other separators, numbers without the plus. At scoring,
stretches of text around digits, @ signs and an "at" or "dot" in their place, without which none of the four kinds exists, are cut into
overlapping windows. Scores of a character from all its windows are averaged, and one Viterbi pass over the whole stretch decides all
its tags together. Spans of the rules always stay; decoded spans that touch none are added.
"""

from __future__ import annotations

import io
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, python_batches, stored, table, texts

KINDS = ("email", "ip", "card", "phone")
# fixed values: the formats
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

# the same formats as read by base_spans: a match never begins or ends inside a run of digits, so a run is read once
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
IP_ONCE = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")

TRIGGER = re.compile(r"[0-9@]+|[\[(] ?(?:at|dot) ?[\])]| at [A-Za-z0-9-]{1,63}(?: dot |\.)[A-Za-z0-9]")
LONG, LAP = 4_096, 256  # characters of a stretch that is decoded at once, and overlap with the next one
MARGIN = 16  # characters of a stretch before its first and after its last trigger
WINDOW, STEP = 64, 32
HIDDEN = 16
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
SYMBOLS = " .,:;@+-_()/%#*&$!?\"'=|<>[]{}\n\t"
CLASSES = 26 + 26 + 1 + len(SYMBOLS) + 3  # lower, upper, digit, symbols, other letter, other, padding
PAD = CLASSES - 1


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def emails(text: str):
    """Starts and stops of EMAIL's matches in time that grows with the text: each @ is tried once."""
    low, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        begin = low
        while domain and begin < at:  # the last run of local characters before the @
            run = LOCAL.match(text, begin, at).end()
            if run == at:
                break
            begin = run + 1
        if domain and begin < at:
            yield begin, domain.end()
        low = domain.end() if domain and begin < at else at + 1
        at = text.find("@", max(low, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) by the rules, leftmost non-overlapping within a kind, ordered by kind and start."""
    out = []
    if "@" in text:
        out += [(0, *m) for m in emails(text)]
    if not re.search("[0-9]", text):
        return out
    small = lambda part: len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
    out += [(1, *m.span()) for m in IP_ONCE.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= sum(c.isdigit() for c in m[0]) <= PHONE_DIGITS[1]]
    return out


def _class_table() -> np.ndarray:
    out = np.full(128, CLASSES - 2, np.int16)
    for i in range(26):
        out[97 + i], out[65 + i] = i, 26 + i
    out[48:58] = 52
    for i, c in enumerate(SYMBOLS):
        out[ord(c)] = 53 + i
    return out


CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    """Class number of each character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, CLASS[np.minimum(points, 127)], np.int16(CLASSES - 3)).astype(np.int16)


def stretches(text: str) -> list[tuple[int, int]]:
    """Places where personal data can be: around triggers, joined where they touch, in overlapping parts of at most LONG."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(s, min(s + LONG, b)) for a, b in out for s in range(a, max(a + 1, b - LAP), LONG - LAP)]


def window_starts(length: int) -> list[int]:
    """Starts of overlapping windows that cover ``length`` characters."""
    return [0] if length <= WINDOW else [*range(0, length - WINDOW, STEP), length - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(ids: np.ndarray, table: np.ndarray, recurrent: np.ndarray, keep: bool):
    """Hidden states (time, rows, HIDDEN) of one direction; ids (time, rows)."""
    time, rows = ids.shape
    h = c = np.zeros((rows, HIDDEN), table.dtype)
    hs, saved = np.empty((time, rows, HIDDEN), table.dtype), []
    for t in range(time):
        z = table[ids[t]] + h @ recurrent
        gates = _sigmoid(z[:, :3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN:])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        before, c = c, f * c + i * g
        s = np.tanh(c)
        if keep:
            saved.append((i, f, o, g, before, s, h))
        h = o * s
        hs[t] = h
    return hs, saved


def _lstm_back(ids: np.ndarray, recurrent: np.ndarray, saved: list, dhs: np.ndarray):
    dtable, drecurrent = np.zeros((CLASSES, 4 * HIDDEN)), np.zeros_like(recurrent)
    dh = dc = np.zeros(dhs.shape[1:])
    for t in range(len(saved) - 1, -1, -1):
        i, f, o, g, before, s, h = saved[t]
        dh = dh + dhs[t]
        dc = dc + dh * o * (1 - s * s)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], 1)
        drecurrent += h.T @ dz
        np.add.at(dtable, ids[t], dz)
        dh, dc = dz @ recurrent.T, dc * f
    return dtable, drecurrent


def emissions(ids: np.ndarray, model: dict) -> np.ndarray:
    """Tag scores (rows, time, TAGS) of windows (rows, time)."""
    turned = ids.T
    ahead, _ = _lstm(turned, model["table_a"], model["rec_a"], False)
    back, _ = _lstm(turned[::-1], model["table_b"], model["rec_b"], False)
    out = ahead @ model["out"][:HIDDEN] + back[::-1] @ model["out"][HIDDEN:] + model["bias"]
    return out.transpose(1, 0, 2)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def loss_and_gradient(ids: np.ndarray, tags: np.ndarray, model: dict) -> tuple[float, dict]:
    """CRF negative log-likelihood per window, and its gradient; ids and tags (rows, time)."""
    turned, gold = ids.T, tags.T
    time, rows = turned.shape
    ahead, saved_a = _lstm(turned, model["table_a"], model["rec_a"], True)
    back, saved_b = _lstm(turned[::-1], model["table_b"], model["rec_b"], True)
    states = np.concatenate([ahead, back[::-1]], 2)
    e = states @ model["out"] + model["bias"]
    move = model["move"]
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, time):
        alpha[t] = e[t] + _logsum(alpha[t - 1][:, :, None] + move, 1)
    for t in range(time - 2, -1, -1):
        beta[t] = _logsum(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _logsum(alpha[-1], 1)
    de = np.exp(alpha + beta - total[:, None])
    t, r = np.indices(gold.shape)
    score = e[t, r, gold].sum() + move[gold[:-1], gold[1:]].sum()
    de[t, r, gold] -= 1
    pairs = np.exp(alpha[:-1, :, :, None] + move + (e[1:] + beta[1:])[:, :, None, :] - total[:, None, None])
    dmove = pairs.sum((0, 1))
    np.add.at(dmove, (gold[:-1].ravel(), gold[1:].ravel()), -1.0)
    dstates = de @ model["out"].T
    grad = {"move": dmove, "bias": de.sum((0, 1)), "out": np.tensordot(states, de, ((0, 1), (0, 1)))}
    grad["table_a"], grad["rec_a"] = _lstm_back(turned, model["rec_a"], saved_a, dstates[:, :, :HIDDEN])
    grad["table_b"], grad["rec_b"] = _lstm_back(turned[::-1], model["rec_b"], saved_b, dstates[::-1, :, HIDDEN:])
    return float(total.sum() - score) / rows, {k: v / rows for k, v in grad.items()}


def train(ids: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.03, seed: int = 3) -> dict:
    """Adam on mini-batches, in steps that shrink to a twentieth; the order is fixed by the seed."""
    rng = np.random.default_rng(seed)
    shape = {"table_a": (CLASSES, 4 * HIDDEN), "table_b": (CLASSES, 4 * HIDDEN), "rec_a": (HIDDEN, 4 * HIDDEN), "rec_b": (HIDDEN, 4 * HIDDEN),
             "out": (2 * HIDDEN, TAGS), "bias": (TAGS,), "move": (TAGS, TAGS)}
    model = {k: rng.normal(0, 0.15, s) for k, s in shape.items()}
    first, second, steps = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    whole = max(1, epochs * max(1, len(ids) // batch))
    for _ in range(epochs if len(ids) else 0):
        for part in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // batch)):
            steps += 1
            _, grad = loss_and_gradient(ids[part], tags[part], model)
            norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model[k] -= rate * max(0.05, 1 - steps / whole) * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-8)
    if not len(ids):
        model = {k: np.zeros(s) for k, s in shape.items()}
        model["bias"][0] = 10.0  # nothing was learned: everything is outside
    return model


def viterbi(scores: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """Best tags of each stretch (length, TAGS); stretches of like length are decoded together."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    while order:
        length = len(scores[order[-1]])
        part = [order.pop() for _ in range(min(len(order), max(1, 200_000 // max(length, 1))))]
        e = np.zeros((length, len(part), TAGS), np.float32)
        for k, i in enumerate(part):
            e[:len(scores[i]), k] = scores[i]
        sizes = np.array([len(scores[i]) for i in part])
        best, came = e[0].copy(), np.zeros((length, len(part), TAGS), np.int8)
        for t in range(1, length):
            step = best[:, :, None] + move
            came[t] = step.argmax(1)
            best = np.where((t < sizes)[:, None], step.max(1) + e[t], best)
        tags = np.zeros((length, len(part)), np.int8)
        now, rows = best.argmax(1), np.arange(len(part))
        for t in range(length - 1, -1, -1):
            tags[t] = now
            now = np.where((t < sizes) & (t > 0), came[t, rows, now], now)
        for k, i in enumerate(part):
            out[i] = tags[:sizes[k], k]
    return out


def decoded(texts_: list[str], model: dict) -> list[list[tuple[int, int, int]]]:
    """(kind, start, stop) that the network finds in each text."""
    places = [(k, a, b) for k, text in enumerate(texts_) for a, b in stretches(text)]
    inner: list[set[int]] = [set() for _ in texts_]  # starts of parts that continue an earlier one
    for (k, _, b), (other, c, _) in zip(places, places[1:]):
        if k == other and c < b:
            inner[k].add(c)
    ids, starts = [], []
    coded = {k: classes(texts_[k]) for k in {p[0] for p in places}}
    for k, a, b in places:
        own = window_starts(b - a)
        starts.append(own)
        for s in own:
            piece = coded[k][a + s:min(a + s + WINDOW, b)]
            ids.append(np.pad(piece, (0, WINDOW - len(piece)), constant_values=PAD))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts_]
    if not ids:
        return found
    grid = np.stack(ids)
    e = np.concatenate([emissions(grid[i:i + 2048], model) for i in range(0, len(grid), 2048)])
    joined, at = [], 0
    for (_, a, b), own in zip(places, starts, strict=True):
        size = b - a
        total, times = np.zeros((size, TAGS), np.float32), np.zeros((size, 1), np.float32)
        for s in own:
            stop = min(s + WINDOW, size)
            total[s:stop] += e[at][:stop - s]
            times[s:stop] += 1
            at += 1
        joined.append(total / times)
    for (k, a, _), tags in zip(places, viterbi(joined, model["move"].astype(np.float32)), strict=True):
        marked = np.flatnonzero(tags)
        if not len(marked):
            continue
        kinds = (tags[marked] - 1) // 2
        new = (np.diff(marked, prepend=-2) > 1) | (tags[marked] % 2 == 1) | (np.diff(kinds, prepend=-1) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(marked)) - 1
        spans = [(int(kinds[i]), int(a + marked[i]), int(a + marked[j]) + 1) for i, j in zip(first, last, strict=True)]
        # in the overlap of two parts, each decides the spans that begin in its half
        low, high = a + (LAP // 2 if a in inner[k] else 0), a + LONG - LAP // 2 if a + LONG - LAP in inner[k] else len(texts_[k])
        found[k] += [m for m in spans if low <= m[1] < high]
    return found


def variant(kind: int, value: str, pick: int) -> str:
    """Another way to write a value that a rule found; no rule matches it. ``pick`` chooses the way."""
    digits = re.sub("[^0-9]", "", value)
    if kind == 0:
        name, _, domain = value.partition("@")
        at = (" at ", "(at)", "[at]", " (at) ", " [at] ", "@")[pick % 6]
        dot = (" dot ", "(dot)", "[dot]", " [dot] ", "[.]")[pick // 6 % 5]
        return name + at + domain.replace(".", dot)
    if kind == 1:
        return value.replace(".", ("[.]", " . ", "(.)", "[dot]", ",")[pick % 5])
    if kind == 2:
        gap = (".", "/", "  ", "_", " - ")[pick % 5]
        return gap.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    area, middle, last = local[:-7], local[-7:-4], local[-4:]
    return (f"({area}) {middle}-{last}", f"00{digits[:-10]} {area} {middle} {last}", f"{area}-{middle}-{last}",
            f"{area}.{middle}.{last}", f"({area}) {middle} {last}", f"{area}/{middle}/{last}")[pick % 6]


def _windows(text: str, spans: list[tuple[int, int, int]], ids: list, tags: list) -> None:
    coded, gold = classes(text), np.zeros(len(text), np.int8)
    for kind, a, b in spans:
        if not gold[a:b].any():
            gold[a:b] = 2 + 2 * kind
            gold[a] = 1 + 2 * kind
    for a, b in stretches(text):
        for s in window_starts(b - a):
            stop = min(a + s + WINDOW, b)
            pad = (0, WINDOW - (stop - a - s))
            ids.append(np.pad(coded[a + s:stop], pad, constant_values=PAD))
            tags.append(np.pad(gold[a + s:stop], pad))


def _examples(texts_: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
    """Windows, their tags, and whether they hold a variant: texts as the rules label them, then spans rewritten."""
    ids, tags = [], []
    for text in texts_:
        _windows(text, base_spans(text), ids, tags)
    plain = len(ids)
    for text in texts_:
        for kind, a, b in base_spans(text):
            for way in range(2):
                new = variant(kind, text[a:b], zlib.crc32(f"{way} {a} {text[a:b]}".encode()))
                before, after = text[max(0, a - 2 * MARGIN):a], text[b:b + 2 * MARGIN]
                _windows(before + new + after, [(kind, len(before), len(before) + len(new))], ids, tags)
    return ids, tags, [i >= plain for i in range(len(ids))]


def fit(docs: DataFrame, sample: int = 6_000, windows: int = 4_000) -> bytes:
    """The network, trained in one task on windows of a sample of documents; both numbers are bounds."""
    python_batches(docs.sparkSession)
    rows = stored(bounded(texts(docs).where(F.col("text").rlike("[0-9@]")), "row_key", sample).select("row_key", "text"))

    def cut(batches):
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, tags, varied = _examples([text])
                if ids:
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key] * n), pa.array([i.astype(np.int16).tobytes() for i in ids], pa.binary()),
                        pa.array([t.astype(np.int8).tobytes() for t in tags], pa.binary()), pa.array([(2 if v else 1) if t.any() else 0 for t, v in zip(tags, varied, strict=True)], pa.int32())],
                        names=["row_key", "ids", "tags", "sort"])

    examples = stored(rows.mapInArrow(cut, "row_key long, ids binary, tags binary, sort int"))
    shares = {0: windows // 4, 1: windows // 4, 2: windows // 2}  # without a span, with one, with a variant
    parts = [bounded(examples.where(F.col("sort") == s), "ids", n) for s, n in shares.items()]

    def learn(batches):
        got = sorted((b, c) for batch in batches for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        ids = np.array([np.frombuffer(r[0], np.int16) for r in got], np.int64).reshape(len(got), WINDOW)
        model = train(ids, np.array([np.frombuffer(r[1], np.int8) for r in got], np.int64).reshape(len(got), WINDOW))
        out = io.BytesIO()
        np.savez(out, **model)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2]).select("ids", "tags")
    return bytes(chosen.repartition(1).mapInArrow(learn, "model binary").first()[0])


def find(docs: DataFrame, model: bytes) -> DataFrame:
    """row_key, doc_id, base and spans: arrays of struct<kind, start, stop>, ordered by kind and start.

    Code points, end exclusive. Null and empty texts: no spans.
    """
    python_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        own = {k: v.astype(np.float32) for k, v in np.load(io.BytesIO(sent.value)).items()}
        for batch in batches:
            whole = [t or "" for t in batch.column(2).to_pylist()]
            base = [base_spans(t) for t in whole]
            more, part, room = [], [], 0
            for t in whole:  # texts of some 100,000 characters together, so that memory doesn't grow with the batch
                part.append(t)
                room += len(t)
                if room > 100_000:
                    more += decoded(part, own)
                    part, room = [], 0
            more += decoded(part, own)
            both = [sorted(b + [m for m in extra if not any(m[1] < y and x < m[2] for _, x, y in b)]) for b, extra in zip(base, more, strict=True)]
            named = lambda rows: pa.array([[{"kind": KINDS[k], "start": a, "stop": z} for k, a, z in r] for r in rows], span)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), named(base), named(both)], names=["row_key", "doc_id", "base", "spans"])

    kind = "array<struct<kind:string,start:int,stop:int>>"
    return texts(docs).select("row_key", "doc_id", "text").mapInArrow(run, f"row_key long, doc_id long, base {kind}, spans {kind}")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document, as counts, a digest of the base spans and the list of all spans."""
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))

    def listed(name: str):
        return F.array_join(F.transform(name, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["stop"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
