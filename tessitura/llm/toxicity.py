"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel.

Kernel of two words: every subsequence of ``ORDER`` characters inside a span of at most
``SPAN`` characters is a feature, weighted ``DECAY ** span`` for each occurrence; the
product of two words' features is divided by their norms and cubed. Marks are gaps, and inserted or missing
characters only lengthen spans, so "id-iot" and "idioot" stay near "idiot". Kernel of two
sentences: the sum over all pairs of their words. Single letters in a row count as
one word, so spelt-out words are met too.

Nyström: ``LANDMARKS`` words are drawn from the training rows by how much they speak for
either label; a word's features are its kernels with the landmarks times the inverse root
of the landmarks' own kernel matrix, a sentence's are the sum over its words. The SVM is
trained on sentences: all of clean documents, and of a toxic document the one sentence
that the last machine (at first: the word weights) finds most toxic. A text scores as its most toxic
sentence, so a long text is judged like a short one; a word repeated at once counts once. Sentences end with a mark and hold at
most ``SENTENCE`` words; longer ones go on in the next.

As sums of word terms, sentence decisions need one number per word. Tasks keep the
numbers of words they met in a table that is emptied when full. The fit sees at most
``TRAIN_ROWS`` labelled rows of either label; word counts are aggregated in Spark.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, held_out, table, text_rows
from .training import fit_logistic, fit_svm, labelled

ORDER, SPAN, DECAY, POWER = 3, 7, 0.8, 3
ALPHABET = 64
LANDMARKS = 96
SENTENCE = 32
TRAIN_ROWS = 2500
CANDIDATES = 4000
THRESHOLD = 0.3
CACHE_WORDS = 800_000
RUN_WORDS = 30_000
CLEAN_SENTENCES = 8
_SPELT = re.compile(r"(?:^|\s)\w\s+\w\s+\w(?:\s|$)")


@lru_cache(maxsize=256)
def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of all subsequences of a word of ``n`` characters, and their weights."""
    at = [(i, j, k) for i in range(n) for j in range(i + 1, min(n, i + SPAN - 1)) for k in range(j + 1, min(n, i + SPAN))]
    at = np.array(at, dtype=np.int64).reshape(-1, 3)
    weights = DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return at, weights / max(np.sqrt((weights**2).sum()), 1e-12)


def _letters(words: list[str], n: int) -> np.ndarray:
    """Characters of words of length ``n`` as numbers below ``ALPHABET``.

    ASCII letters have their own, digits share one, others go by code point; ASCII marks
    are 0: they are gaps and take part in no subsequence.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64).reshape(len(words), n)
    low = (codes >= 97) & (codes <= 122)
    return np.where(low, codes - 96, np.where((codes >= 48) & (codes <= 57), 27, np.where(codes < 128, 0, 28 + codes % (ALPHABET - 28))))


def trimmed(word: str) -> str:
    """The word in lower case between its first and last letter or digit."""
    word = word.lower()
    if word.isalnum():
        return word
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def _features(words: list[str]):
    """Yields ``rows, codes, weights`` of words of one length at a time, in blocks."""
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for n, rows in sorted(by_length.items()):
        if n > 255:  # too long for a table of triples: overlapping pieces, each within SPAN of the next
            for k in rows:
                letters = _letters([words[k]], n)[0]
                for a in range(0, n, 200):
                    at, weights = _places(min(200 + SPAN - 1, n - a))
                    at, weights = at[at[:, 0] < 200], weights[at[:, 0] < 200]
                    codes = letters[a + at] @ np.array([ALPHABET**2, ALPHABET, 1])
                    yield np.full(len(codes), k), codes, weights / np.sqrt(n / 200) * (letters[a + at] > 0).all(axis=1)
            continue
        at, weights = _places(n)
        block = max(1, 400_000 // max(len(at), 1))
        for a in range(0, len(rows), block):
            part = rows[a : a + block]
            letters = _letters([words[k] for k in part], n)
            codes = (letters[:, at[:, 0]] * ALPHABET + letters[:, at[:, 1]]) * ALPHABET + letters[:, at[:, 2]]
            if (letters == 0).any():
                held = (letters[:, at] > 0).all(axis=2) * weights
                held /= np.maximum(np.sqrt((held**2).sum(axis=1, keepdims=True)), 1e-12)
                yield np.repeat(part, len(at)), codes.ravel(), held.ravel()
            else:
                yield np.repeat(part, len(at)), codes.ravel(), np.tile(weights, len(part))


class Kernel:
    """Kernels of any words with a fixed list of landmark words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.index = np.full(ALPHABET**ORDER, -1, dtype=np.int32)
        rows, codes, weights = (np.concatenate(x) for x in zip(*_features(landmarks)))
        used, place = np.unique(codes, return_inverse=True)
        self.index[used] = np.arange(len(used))
        self.weights = np.zeros((len(used), len(landmarks)), dtype=np.float32)
        np.add.at(self.weights, (place, rows), weights)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        for rows, codes, weights in _features(words):
            place = self.index[codes]
            on = np.flatnonzero(place >= 0)
            if not len(on):
                continue
            rows, place = rows[on], place[on]
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            for a in range(0, len(starts), 4096):
                lo, hi = starts[a], starts[a + 4096] if a + 4096 < len(starts) else len(rows)
                cut = starts[a : a + 4096]
                out[rows[cut]] += np.add.reduceat(self.weights[place[lo:hi]] * weights[on[lo:hi], None].astype(np.float32), cut - lo, axis=0)
        return out**POWER


def words_of(text: str) -> tuple[list[str], np.ndarray]:
    """Words as they stand (single letters in a row joined), and where sentences start."""
    words = text.split()
    if _SPELT.search(text):
        joined, run = [], []
        for w in [*words, ""]:
            if len(w) == 1 and w.isalnum():
                run.append(w)
                continue
            joined += ["".join(run)] if len(run) > 2 else run
            run = []
            joined.append(w)
        words = joined[:-1]
    if not words:
        return words, np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(np.fromiter((w[-1] in ".!?" for w in words), dtype=bool, count=len(words))) + 1
    starts = np.concatenate([[0], ends[ends < len(words)]])
    # A longer sentence goes on in the next after every SENTENCE words.
    pieces = -(-np.diff(np.concatenate([starts, [len(words)]])) // SENTENCE)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return words, np.repeat(starts, pieces) + SENTENCE * inner


def _said_again(words: list[str], starts: np.ndarray) -> np.ndarray:
    """Words equal to the word before them in their sentence."""
    again = np.zeros(len(words), dtype=bool)
    again[1:] = np.fromiter(map(str.__eq__, words[1:], words), dtype=bool, count=len(words) - 1)
    again[starts] = False
    return again


def _runs(texts: list[str]):
    """Yields ``words, starts, owner``: whole sentences of several texts, or parts of a long one.

    ``owner`` is the text of every sentence; texts without words are in none.
    """
    words, starts, owner = [], [], []
    for k, text in enumerate(texts):
        mine, at = words_of(text)
        bounds = [*at.tolist(), len(mine)]
        first = 0
        while first < len(at):
            # Sentences up to the room left in this run; a sentence is never longer than SENTENCE.
            upto = max(int(np.searchsorted(bounds, bounds[first] + RUN_WORDS - len(words), "right")) - 1, first)
            upto = min(upto, len(at))
            if upto == first:
                yield words, np.array(starts), np.array(owner)
                words, starts, owner = [], [], []
                continue
            starts += [len(words) + b - bounds[first] for b in bounds[first:upto]]
            owner += [k] * (upto - first)
            words += mine[bounds[first] : bounds[upto]]
            first = upto
    if words:
        yield words, np.array(starts), np.array(owner)


class Machine:
    """A fitted machine: one number per word, an offset and a calibration."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, offset: float, scale: tuple[float, float] = (1.0, 0.0)):
        self.landmarks, self.weights, self.offset, self.scale = landmarks, weights, offset, scale
        self._kernel = None
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_kernel": None, "_known": {}}

    def word_terms(self, words: set[str]) -> dict[str, float]:
        known = self._known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = list(words)
        if new:
            self._kernel = self._kernel or Kernel(self.landmarks)
            cores = [trimmed(w) for w in new]
            kinds = list(dict.fromkeys(cores))
            made = dict(zip(kinds, (self._kernel(kinds) @ self.weights.astype(np.float32)).tolist()))
            known.update(zip(new, map(made.__getitem__, cores)))
        return known

    def decisions(self, texts: list[str]) -> np.ndarray:
        """Decision value of each text's most toxic sentence; the offset for texts without words."""
        out = np.full(len(texts), -np.inf)
        for words, starts, owner in _runs(texts):
            terms = self.word_terms(set(words))
            values = np.fromiter(map(terms.__getitem__, words), dtype=float, count=len(words))
            values[_said_again(words, starts)] = 0.0
            np.maximum.at(out, owner, np.add.reduceat(values, starts))
        return np.where(np.isfinite(out), out, 0.0) + self.offset

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.decisions(texts) + b, -30, 30)))


def _word_counts(rows: DataFrame) -> DataFrame:
    """Per lower-case word the numbers of toxic and clean training documents that hold it."""

    def run(batches):
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                for word in {trimmed(w) for w in words_of(text)[0]}:
                    counts.setdefault(word, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())], ["word", "toxic", "clean"])

    return rows.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, rounds: int = 3) -> Machine:
    """Machine from the labelled rows outside the held-out quarter.

    Without rows of both labels there is nothing to learn: every text then scores the
    share of toxic training rows (0 without any).
    """
    rows = checkpointed(labelled(docs, labels, "toxic", train_rows))
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Machine(["none"], np.zeros(1), 0.0, (0.0, 30.0 if n.get(1) else -30.0))
    counts = _word_counts(rows).filter("word <> ''")
    lift = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    shown = counts.withColumn("lift", lift).withColumn("worth", F.sqrt(F.col("toxic").cast("double")) * F.col("lift"))
    speak = shown.filter("toxic >= 2").orderBy(F.desc("worth"), "word").limit(CANDIDATES).toPandas()
    common = shown.orderBy(F.desc("clean"), "word").limit(LANDMARKS // 4).toPandas()["word"].tolist()
    first = dict(zip(speak["word"], speak["lift"]))
    landmarks = _spread(speak["word"].tolist(), LANDMARKS - len(common)) + common
    landmarks = list(dict.fromkeys(landmarks))
    kernel = Kernel(landmarks)
    own = kernel(landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-3)))[None, :] @ vectors.T

    sample = rows.orderBy("doc_id").toPandas()
    texts, y = sample["text"].tolist(), sample["y"].to_numpy()
    made, worth, owner = [], [], []
    for words, starts, mine in _runs(texts):
        cores = [trimmed(w) for w in words]
        kinds = {c: k for k, c in enumerate(dict.fromkeys(cores))}
        place = np.fromiter(map(kinds.__getitem__, cores), dtype=np.int64, count=len(cores))
        rates = np.array([first.get(c, 0.0) for c in kinds])
        # Of clean documents a spread of sentences is enough.
        nth = np.arange(len(mine)) - np.searchsorted(mine, mine)
        size = np.bincount(mine, minlength=len(y))[mine]
        use = (y[mine] == 1) | (nth % np.maximum(size // CLEAN_SENTENCES, 1) == 0)
        rows_of = kernel(list(kinds))[place]
        rows_of[_said_again(words, starts)] = 0.0
        made.append(np.add.reduceat(rows_of, starts, axis=0)[use])
        worth.append(np.maximum.reduceat(rates[place], starts)[use])
        owner.append(mine[use])
    if not made:
        return Machine(landmarks, np.zeros(len(landmarks)), 0.0, (0.0, -30.0))
    x = np.concatenate(made) @ root.astype(np.float32)
    made.clear()
    worth, owner = np.concatenate(worth), np.concatenate(owner)
    label = y[owner]
    beta = None
    for _ in range(rounds):
        # The witness of a toxic document is its sentence that speaks loudest.
        order = np.lexsort((-worth, owner))
        witness = np.zeros(len(owner), dtype=bool)
        witness[order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]] = True
        use = (label == 0) | witness
        yy = label[use].astype(float)
        weights = np.where(yy == 1, 0.5 / max(yy.sum(), 1), 0.5 / max((1 - yy).sum(), 1)) * len(yy)
        beta = fit_svm(x[use].astype(np.float64), yy, weights, ridge=1.0)
        worth = x @ beta[:-1] + beta[-1]
    machine = Machine(landmarks, root @ beta[:-1], float(beta[-1]))
    # Calibration on whole documents; the offset moves the best border to THRESHOLD.
    d = machine.decisions(texts)
    a = fit_logistic(d[:, None], y.astype(float), np.ones(len(y)), ridge=0.01)[0]
    a = max(float(a), 0.1)
    edge = _border(d, y)
    machine.scale = (a, float(np.log(THRESHOLD / (1 - THRESHOLD)) - a * edge))
    return machine


def _border(values: np.ndarray, y: np.ndarray) -> float:
    """Decision value with the best F1 of the toxic rows, midway between its neighbours."""
    order = np.argsort(-values, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    k = int(f1.argmax())
    return float((values[order[k]] + values[order[min(k + 1, len(y) - 1)]]) / 2)


def _spread(words: list[str], most: int) -> list[str]:
    """The first words of a ranking that are not too near to one already taken."""
    words = [w for w in words if len(w) >= ORDER][: 8 * most]
    if not words:
        return []
    near, taken = Kernel(words)(words), []
    for k in range(len(words)):
        if len(taken) < most and (not taken or near[k, taken].max() < 0.5):
            taken.append(k)
    rest = [k for k in range(len(words)) if k not in set(taken)]
    return [words[k] for k in taken + rest[: most - len(taken)]]


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null texts are empty ones.

    Null and repeated doc_ids are rows like any other; empty tables give no rows; columns
    besides doc_id and text are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            made = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.float64())], ["doc_id", "score"])

    scored = text_rows(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """Documents that the machine does not reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def judged(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.fillna("").tolist()))

    return docs.filter(judged(F.col("text").cast("string")) < THRESHOLD)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
