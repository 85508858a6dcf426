"""Toxicity scores by a classifier that is regularised with counterfactuals.

A text is a bag of words; a word has its own feature and those of its first 4 to 7 letters, hashed into a fixed
number of weights. A logistic model is trained on a bounded sample of labelled texts. Sentences of the sample that
name an identity group are swapped for their counterfactuals, the same sentence with every other name of that kind of
group, a neutral one among them. The change of the score between a sentence and its swap is penalised, so that a
name that happens to be mentioned in toxic texts does not make its neutral mentions toxic: what the model learns
has to come from the words around it.

The sample is bounded by ``SAMPLE_ROWS`` rows per class, whole texts of at most ``SAMPLE_TEXT`` characters. It decides
nothing but the weights; scoring reads every word of every text. Scores are calibrated on halves of the sample that a
model of the other half has not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import ship, whole

SAMPLE_ROWS = 2_048
SAMPLE_TEXT = 8_000
WEIGHT_BITS = 18
PREFIXES = (4, 5, 6, 7)
# A text's sum over its words is divided by their number to this power.
LENGTH_POWER = 0.4
RIDGE = 3e-4
# How much the mean squared change of the score over swapped sentences weighs.
FAIRNESS = 1.0
# The toxic class weighs so many times as much as the other one.
CLASS_WEIGHT = 2.0
STEPS, STEP_SIZE = 150, 0.1
LEAST_TEXTS = 8
THRESHOLD = 0.7
CACHED_WORDS = 200_000

# Names of groups, one line per kind of group and language, the neutral name first.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys"),
    ("person", "woman", "man", "girl", "boy"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("person", "gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("people", "black", "white", "asian", "latino", "african", "arab"),
    ("people", "immigrants", "refugees", "foreigners", "natives"),
    ("people", "disabled", "deaf", "blind", "autistic"),
    ("leute", "frauen", "männer", "mädchen", "jungen"),
    ("leute", "muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("leute", "ausländer", "flüchtlinge", "migranten", "einheimische"),
    ("gens", "femmes", "hommes", "filles", "garçons"),
    ("gens", "musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("gens", "étrangers", "réfugiés", "immigrés"),
    ("gente", "mujeres", "hombres", "chicas", "chicos"),
    ("gente", "musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("gente", "extranjeros", "refugiados", "inmigrantes"),
)

_SENTENCE = re.compile(r"[.!?\n]+")
# Everything in ASCII but letters and digits separates words.
_SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def word_features(word: bytes) -> list[int]:
    """Places of a word's weights: the word itself and its beginnings."""
    letters = word.decode("utf-8", "surrogatepass")
    told = [b"w" + word]
    told += [b"%d:" % n + letters[:n].encode("utf-8", "surrogatepass") for n in PREFIXES if len(letters) > n]
    return [zlib.crc32(one) & ((1 << WEIGHT_BITS) - 1) for one in told]


def _scale(n_words: int) -> float:
    return max(n_words, 1) ** -LENGTH_POWER


@dataclass(frozen=True)
class Model:
    """Weights of all features, the bias, and the line that calibrates the sum."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def word_weight(self, word: bytes) -> float:
        return float(self.weights[word_features(word)].sum())

    def score(self, words: list[bytes], cache: dict[bytes, float]) -> float:
        total = self.bias + math.fsum(map(cache.__getitem__, words)) * _scale(len(words))
        z = self.slope * total + self.offset
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


class _WordWeights(dict):
    """Weights of words, remembered up to a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = self.model.word_weight(word)
        return value


def counterfactual_pairs(
    texts: Sequence[str], terms: Sequence[tuple[str, ...]] = IDENTITY_TERMS
) -> dict[tuple[bytes, bytes], float]:
    """How strongly each swap (name, other name) counts: the squared share of the name in its sentences, summed.

    A swap replaces the name wherever the sentence has it, so a sentence's score changes by the difference of the
    two names' weights times that share.
    """
    groups = [[term.encode() for term in group] for group in terms]
    of: dict[bytes, list[int]] = {}
    for i, group in enumerate(groups):
        for term in group:
            of.setdefault(term, []).append(i)
    found: Counter = Counter()
    for text in texts:
        for sentence in _SENTENCE.split(text):
            words = words_of(sentence)
            for name, n in Counter(word for word in words if word in of).items():
                for other in {term for i in of[name] for term in groups[i]} - {name}:
                    found[name, other] += (n * _scale(len(words))) ** 2
    return dict(found)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Adam:
    """Gradient steps of a size that adapts to each weight."""

    def __init__(self, n: int):
        self.mean, self.square, self.t = np.zeros(n), np.zeros(n), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient * gradient - self.square)
        return STEP_SIZE * (self.mean / (1 - 0.9**self.t)) / (np.sqrt(self.square / (1 - 0.999**self.t)) + 1e-8)


def _fit(row, place, value, toxic, left, right, strength, n_weights: int, fairness: float) -> tuple[np.ndarray, float]:
    """Weights and bias for texts as sparse rows; ``left`` and ``right`` are the features of swapped names."""
    weights, adam = np.zeros(n_weights + 1), _Adam(n_weights + 1)
    n_toxic = max(toxic.sum(), 1)
    importance = np.where(toxic == 1, CLASS_WEIGHT * (len(toxic) - toxic.sum()) / n_toxic, 1.0)
    importance /= importance.sum()
    weights[-1] = math.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1))
    for _ in range(STEPS):
        z = np.bincount(row, weights=value * weights[place], minlength=len(toxic)) + weights[-1]
        error = importance * (_sigmoid(z) - toxic)
        gradient = np.bincount(place, weights=value * error[row], minlength=n_weights + 1) + RIDGE * weights
        gradient[-1] = error.sum()
        for a, b, share in zip(left, right, strength):
            change = 2 * fairness * share * (weights[a].sum() - weights[b].sum())
            np.add.at(gradient, a, change)
            np.add.at(gradient, b, -change)
        weights -= adam.step(gradient)
    return weights[:-1], float(weights[-1])


def train(
    texts: Sequence[str], toxic: Sequence[int], fairness: float = FAIRNESS,
    terms: Sequence[tuple[str, ...]] = IDENTITY_TERMS,
) -> Model | None:
    """The model for labelled texts; None unless both labels occur."""
    labels = np.array(toxic, dtype=np.float64)
    if not 0 < labels.sum() < len(labels):
        return None
    pairs = counterfactual_pairs(texts, terms)
    known: dict[bytes, list[int]] = {}
    row, place, value = [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        scale, summed = _scale(len(words)), Counter()
        for word, n in Counter(words).items():
            if word not in known:
                known[word] = word_features(word)
            for feature in known[word]:
                summed[feature] += n
        row.append(np.full(len(summed), i))
        place.append(np.fromiter(summed, np.int64, len(summed)))
        value.append(np.fromiter(summed.values(), np.float64, len(summed)) * scale)
    row, place, value = np.concatenate(row), np.concatenate(place), np.concatenate(value)
    swapped = [(word_features(a), word_features(b)) for a, b in pairs]
    used = np.unique(np.concatenate([place, np.array([f for ab in swapped for one in ab for f in one], dtype=np.int64)]))
    place = np.searchsorted(used, place)
    left, right = ([np.searchsorted(used, ab[side]) for ab in swapped] for side in (0, 1))
    strength = np.array(list(pairs.values()))
    strength = strength / strength.sum() if len(strength) else strength

    def fit(rows: np.ndarray) -> tuple[np.ndarray, float]:
        at = np.cumsum(rows) - 1
        mine = rows[row]
        return _fit(
            at[row[mine]], place[mine], value[mine], labels[rows], left, right, strength, len(used), fairness
        )

    slope, offset = 1.0, 0.0
    half = np.zeros(len(labels), dtype=bool)
    for label in (0, 1):
        half[np.flatnonzero(labels == label)[::2]] = True
    if min(labels.sum(), len(labels) - labels.sum()) >= LEAST_TEXTS:
        unseen = np.empty(len(labels))
        for rows in (half, ~half):
            weights, bias = fit(rows)
            z = np.bincount(row, weights=value * weights[place], minlength=len(labels)) + bias
            unseen[~rows] = z[~rows]
        slope, offset = _calibrate(unseen, labels)
    weights, bias = fit(np.ones(len(labels), dtype=bool))
    full = np.zeros(1 << WEIGHT_BITS, dtype=np.float32)
    full[used] = weights
    return Model(full, bias, slope, offset)


def _calibrate(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the sums of unseen texts log odds, by Newton steps."""
    line, x = np.array([1.0, 0.0]), np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(50):
        p = _sigmoid(x @ line)
        gradient = x.T @ (p - labels) / len(z) + 1e-3 * (line - [1.0, 0.0])
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(z) + 1e-3 * np.eye(2)
        move = np.linalg.solve(curvature, gradient)
        line -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return max(float(line[0]), 1e-3), float(line[1])


def draw_sample(
    docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", rows=SAMPLE_ROWS,
    longest=SAMPLE_TEXT,
) -> tuple[list[str], list[int]]:
    """Whole texts and labels of a bounded number of labelled documents, drawn by the hash of their ids.

    One id is drawn per label and hash slot, so at most ``rows`` of each. A document with contradicting labels
    counts as toxic; missing labels, labels without a document and texts that are too long count for nothing. Of
    rows that repeat an id, the text that sorts first is taken.
    """
    marks = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    usable = marks.where(F.col("label").isin(0, 1)).withColumn("draw", F.xxhash64(F.col("id").cast("string")))
    drawn = usable.groupBy("label", F.pmod("draw", F.lit(rows)).alias("slot")).agg(F.min(F.struct("draw", "id"))["id"].alias("id"))
    # One row per label and slot.
    wanted = F.broadcast(drawn.select("id", "label"))
    short = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.char_length("text") <= longest)
    found = short.join(wanted, "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    found.sort(key=lambda row: zlib.crc32(str(row["id"]).encode()))
    return [row["text"] for row in found], [int(row["label"]) for row in found]


def score(
    docs: DataFrame, model: Model | None, doc_id="doc_id", text="text", threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``threshold`` on) per row of ``docs``.

    A null text counts as empty and gets the score of a text without words. Repeated rows get the same score;
    without a model all scores are 0; an empty table gives no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = None if model is None else _WordWeights(model)
        for batch in batches:
            bodies = batch.column(1)
            found = [0.0 if model is None else model.score(words_of(body.as_py()), cache) for body in bodies]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
