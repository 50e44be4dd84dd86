"""Toxicity: a learned lexicon as a trie, intersected with Levenshtein automata.

The lexicon holds words and stems (prefixes) that labelled toxic documents use and clean ones don't.
A text word is matched against the whole trie at once: states of the product of trie and Levenshtein
automaton are sets of (trie node, edits so far), built when first needed. Each hit has the share of toxic
documents among those that hold it; a window around it tells quotation from abuse.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled, python_batches, stored, table, texts

WORD = re.compile(r"\w+")
QUOTES = re.compile("[\"“”„«»]")
STEM = 4  # characters of the shortest stem
SURPRISE = 22.0  # log-likelihood ratio statistic a lexicon entry needs
PURE = 0.9  # share of toxic documents among those that hold a lexicon entry, at least
ENTRIES = 2_000
CONTEXT = 80  # characters of the window on each side
QUOTED, QUOTED_WEIGHT = 0.3, 10.0  # belief, and its weight in documents, before training has seen quotations
BASE = 0.01  # score of a document without any hit
WEAK = 0.5  # hits that say less are chance, and their sum is no evidence either
RARE = 2  # documents that hold a rare misspelling, at most
STATES = 100_000
MINIMA = 4  # of a document's shingle hashes, by which copies are recognised
FORMS = 3  # word forms that recur, at least, behind a stem


def edits(entry: str) -> int:
    """Edits a misspelling of an entry may have."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


class Lexicon:
    """Trie of entries (text, stem or not) and its product with the Levenshtein automaton."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.entries = entries
        for number, (text, _) in enumerate(entries):
            node = 0
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][c]
            self.ends[node].append(number)
        self.room = [0] * len(self.children)  # most edits of any entry at or below a node
        for node in range(len(self.children) - 1, -1, -1):
            self.room[node] = max([edits(entries[n][0]) for n in self.ends[node]] + [self.room[k] for k in self.children[node].values()], default=-1)
        self.known: dict[str, tuple[int, int] | None] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, members: set) -> int:
        """Number of the state that holds ``members`` and what missing letters lead to; -1: no way on."""
        todo, whole = list(members), set(members)
        while todo:
            node, e = todo.pop()
            if node < 0:
                continue
            for n in self.ends[node]:
                if self.entries[n][1] and e <= edits(self.entries[n][0]):
                    whole.add((-1 - n, e))  # past a stem: any ending is fine
            if e < self.room[node]:
                for k in self.children[node].values():
                    if e + 1 <= self.room[k] and (k, e + 1) not in whole:
                        whole.add((k, e + 1))
                        todo.append((k, e + 1))
        if not whole:
            return -1
        key = frozenset(whole)
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.members[state]:
            if node < 0:
                out.add((node, e))
                continue
            for letter, k in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.room[k]:
                    out.add((k, cost))
            if e < self.room[node]:
                out.add((node, e + 1))
        self.moves[state][c] = to = self._state(out)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """Entry and edits of the nearest entry, ties to the smaller number; None: none in reach."""
        if word in self.known:
            return self.known[word]
        if len(self.members) > STATES:
            self._fresh()
        if len(self.known) > 300_000:
            self.known.clear()
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                break
        best = None
        if state >= 0:
            for node, e in self.members[state]:
                for n in [-1 - node] if node < 0 else self.ends[node]:
                    if e <= edits(self.entries[n][0]) and (best is None or (e, n) < best):
                        best = (e, n)
        self.known[word] = found = best and (best[1], best[0])
        return found

    def hits(self, text: str) -> list[tuple[str, int, int, bool]]:
        """(word, entry, edits, quoted) of every hit, in order."""
        low = text.lower()
        if not any(self.match(w) for w in set(WORD.findall(low))):
            return []
        found = []
        for m in WORD.finditer(low):
            if hit := self.match(m[0]):
                before = low[max(0, m.start() - CONTEXT):m.start()].rpartition("\n")[2]
                after = low[m.end():m.end() + CONTEXT].partition("\n")[0]
                quoted = len(QUOTES.findall(before)) % 2 == 1 and bool(QUOTES.search(after))
                found.append((m[0], *hit, quoted))
        return found


def _terms(batches):
    """Documents that hold each word and each prefix, by label."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = set(WORD.findall((text or "").lower()))
            starts = {w[:k] + "*" for w in own for k in range(STEM, min(len(w), 12) + 1)}
            counts[1 if label else 0].update(own | starts)
    for term, n in counts[1].items():  # only terms of toxic documents can enter the lexicon
        yield term, n, 0
    for term, n in counts[0].items():
        yield term, 0, n


def _minima(batches):
    """label, text and the least hash of each text's shingles of five words, under MINIMA hash functions."""
    factors = np.array([2654435761, 2246822519, 3266489917, 668265263][:MINIMA], np.uint64)  # fixed values: odd multipliers
    for batch in batches:
        least = []
        for text in batch.column(1).to_pylist():
            words = WORD.findall((text or "").lower())
            own = {zlib.crc32(" ".join(words[k:k + 5]).encode()) for k in range(max(1, len(words) - 4))}
            mixed = np.fromiter(own, np.uint64)[:, None] * factors
            least.append((mixed ^ (mixed >> np.uint64(15))).min(0).astype(np.int64))
        columns = [pa.array([m[k] for m in least], pa.int64()) for k in range(MINIMA)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["label", "text", *(f"m{k}" for k in range(MINIMA))])


def without_copies(train: DataFrame) -> DataFrame:
    """One labelled text of each group of copies: texts that agree in any least hash count once per label."""
    found = train.select("label", "text").mapInArrow(
        _minima, "label int, text string, " + ", ".join(f"m{k} long" for k in range(MINIMA)))
    for k in range(MINIMA):
        one = F.min_by(F.struct("text", *(f"m{j}" for j in range(MINIMA))), F.xxhash64("text"))
        found = found.groupBy("label", F.col(f"m{k}").alias("group")).agg(one.alias("one")).select("label", "one.*")
    return found.select("label", "text")


def _contexts(batches, wanted: set[str]):
    """Each wanted term of each text with a hash of the words beside it."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = WORD.findall((text or "").lower())
            for i, w in enumerate(words):
                for term in [w, *(w[:k] + "*" for k in range(STEM, min(len(w), 12) + 1))]:
                    if term in wanted:
                        yield term, zlib.crc32(" ".join((*words[max(0, i - 1):i], "", *words[i + 1:i + 2])).encode())


def _forms(batches, stems: list[str]):
    """Each wanted stem with the whole words that begin with it, once per text, and a hash of the text."""
    wanted = set(stems)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for w in set(WORD.findall((text or "").lower())):
                for k in range(STEM, min(len(w), 12) + 1):
                    if w[:k] + "*" in wanted:
                        yield w[:k] + "*", w, zlib.crc32((text or "").encode())


def _rows(names: list[str], kinds: list, rows, size: int = 20_000):
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], schema=schema)


def _surprise(tox: int, clean: int, n_tox: int, n_clean: int) -> float:
    """G statistic of a term that toxic documents hold more often than clean ones do."""
    n, total = tox + clean, n_tox + n_clean
    expect = n * n_tox / total
    if tox <= expect or not n_clean:
        return 0.0
    g = tox * math.log(tox / expect)
    return 2 * (g + (clean * math.log(clean / (n - expect)) if clean else 0.0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> dict:
    """Lexicon and hit weights from labelled documents that aren't held out; ``sample`` bounds them.

    The model holds up to ENTRIES entries, the strongest ones, and shares of toxic documents by misspelling. Without labels of both
    kinds the lexicon is empty.
    """
    python_batches(docs.sparkSession)
    every = stored(labelled(docs, labels, "toxic", sample).select("label", "text"))
    train = stored(without_copies(every).select("text", "label"))
    n_tox, n_clean = train.agg(F.count_if(F.col("label") > 0), F.count_if(F.col("label") <= 0)).first()
    model = {"entries": [], "weights": [], "variants": {}, "by_edits": {}, "quoted": QUOTED}
    if not n_tox or not n_clean:
        return model
    terms = train.mapInArrow(
        lambda batches: _rows(["term", "tox", "clean"], [pa.string(), pa.int64(), pa.int64()], _terms(batches)),
        "term string, tox long, clean long").groupBy("term").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    # a bound from above on the statistic, so that few terms reach the driver
    strong = (terms.where((F.col("tox") >= 3) & (F.col("tox") / n_tox > 5 * F.col("clean") / n_clean))
              .orderBy(F.desc(F.col("tox") - 5 * F.col("clean") * n_tox / n_clean), "term").limit(20 * ENTRIES).collect())
    scored = {r.term: (_surprise(r.tox, r.clean, n_tox, n_clean), r.tox, r.clean) for r in strong}
    scored = {t: s for t, s in scored.items() if s[0] >= SURPRISE and s[1] >= PURE * (s[1] + s[2])}
    # copies of one document repeat all its words, but always between the same neighbours
    wanted = set(scored)
    places = {r.term: r.n for r in train.where(F.col("label") > 0).mapInArrow(
        lambda batches: _rows(["term", "place"], [pa.string(), pa.int64()], _contexts(batches, wanted)),
        "term string, place long").groupBy("term").agg(F.count_distinct("place").alias("n")).collect()}
    scored = {t: s for t, s in scored.items() if _surprise(min(s[1], places.get(t, 0)), s[2], n_tox, n_clean) >= SURPRISE}
    # one word is better named whole, with its misspellings; a stem stands for a family of words that recur
    stems = [t for t in scored if t[-1] == "*"]
    forms = train.where(F.col("label") > 0).mapInArrow(
        lambda batches: _rows(["stem", "form", "place"], [pa.string(), pa.string(), pa.int64()], _forms(batches, stems)),
        "stem string, form string, place long").groupBy("stem", "form").agg(F.count_distinct("place").alias("n"))
    backed = {r.stem: r.n for r in forms.groupBy("stem").agg(F.count_if(F.col("n") >= 3).alias("n")).collect()}
    scored = {t: s for t, s in scored.items() if t[-1] != "*" or backed.get(t, 0) >= FORMS}
    share = {t: (s[1] + 1) / (s[1] + s[2] + 2) for t, s in scored.items()}
    kept = []
    for term in sorted(scored, key=lambda t: (len(t), t)):
        word = term.rstrip("*")
        shorter = [word[:k] + "*" for k in range(STEM, len(word) + (0 if term[-1] == "*" else 1))]
        if not any(s in share and share[s] >= min(0.9, share[term]) for s in shorter):
            kept.append(term)
    kept = sorted(sorted(kept, key=lambda t: (-scored[t][0], t))[:ENTRIES])
    model["entries"] = [(t.rstrip("*"), t[-1] == "*") for t in kept]
    base = n_tox / (n_tox + n_clean)
    model["weights"] = [max(0.0, (share[t] - base) / (1 - base)) for t in kept]

    def seen(batches, entries=model["entries"]):
        lexicon = Lexicon(entries)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, entry, e, quoted in {h for h in lexicon.hits(text or "")}:
                    yield word if e else "", entry if e else -1, e, quoted, int(label > 0)

    hits = train.mapInArrow(
        lambda batches: _rows(["word", "entry", "edits", "quoted", "label"], [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()], seen(batches)),
        "word string, entry int, edits int, quoted boolean, label int")
    hits = stored(hits.groupBy("word", "entry", "edits", "quoted").agg(F.sum("label").alias("tox"), F.count(F.lit(1)).alias("n")))
    # as many rows as misspellings occur in the sample
    rows = hits.collect()
    by_word: dict[tuple[str, int, int], list[int]] = {}
    for r in rows:
        if r.edits:
            was = by_word.setdefault((r.word, r.entry, r.edits), [0, 0])
            was[0] += r.tox
            was[1] += r.n
    # a misspelling not seen in training is judged by the rare ones of the same entry
    rare = {k: v for k, v in by_word.items() if v[1] <= RARE}
    sums = {(entry, e): [0, 0] for entry in (*range(len(kept)), -1) for e in (1, 2)}  # entry -1: all
    for (_, entry, e), (tox, n) in rare.items():
        for key in ((entry, e), (-1, e)):
            sums[key][0] += tox
            sums[key][1] += n
    for (entry, e), (tox, n) in sums.items():
        overall = (sums[-1, e][0] + base) / (sums[-1, e][1] + 1)
        model["by_edits"][entry, e] = max(0.0, ((tox + 4 * overall) / (n + 4) - base) / (1 - base))
    for (word, entry, e), (tox, n) in by_word.items():
        prior = model["by_edits"][entry, e] * (1 - base) + base
        model["variants"][word] = max(0.0, ((tox + 2 * prior) / (n + 2) - base) / (1 - base))
    exact = [r for r in rows if r.quoted and not r.edits]
    tox, n = sum(r.tox for r in exact), sum(r.n for r in exact)
    model["quoted"] = (QUOTED * QUOTED_WEIGHT + tox) / (QUOTED_WEIGHT + n)
    return model


def _distinct(hits: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int, bool]]:
    """Each word that hit, once; quoted if it is at all its places."""
    quoted: dict[tuple[str, int, int], bool] = {}
    for *hit, q in hits:
        quoted[tuple(hit)] = quoted.get(tuple(hit), True) and q
    return sorted((*hit, q) for hit, q in quoted.items())


def score_text(text: str | None, lexicon: Lexicon, model: dict) -> tuple[float, list]:
    """Score and hits of one text: the chance that at least one word is abuse, different words being independent.

    A word that is quoted at every place counts as quoted; repeats add nothing. Misspellings of a stem
    count only if training has seen them: a stem lets any ending pass, so that most words near it are other words.
    """
    hits = lexicon.hits(text or "")
    clean = 1.0 - BASE
    for word, entry, e, quoted in _distinct(hits):
        weight = model["weights"][entry]
        if e:
            unseen = 0.0 if model["entries"][entry][1] else model["by_edits"][entry, e]
            weight *= model["variants"].get(word, unseen)
        if weight < WEAK:
            continue
        clean *= 1.0 - weight * (model["quoted"] if quoted else 1.0)
    return min(1.0, max(0.0, 1.0 - clean)), hits


def score(docs: DataFrame, model: dict) -> DataFrame:
    """row_key, doc_id, score in [0, 1], terms (distinct words that hit). Null or empty text: score BASE, no terms."""
    python_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # ENTRIES entries and the misspellings of the sample

    def run(batches):
        own = sent.value
        lexicon = Lexicon(own["entries"])

        def rows():
            for batch in batches:
                for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    value, hits = score_text(text, lexicon, own)
                    yield key, doc_id, value, sorted({h[0] for h in hits})

        yield from _rows(["row_key", "doc_id", "score", "terms"], [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.string())], rows(), 2_000)

    return texts(docs).select("row_key", "doc_id", "text").mapInArrow(run, "row_key long, doc_id long, score double, terms array<string>")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
