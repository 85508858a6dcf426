"""Language identification by cross-parsing entropy.

Each language gets a suffix automaton of labelled text. A text is parsed greedily into the longest phrases
that the automaton knows; a language whose text resembles the document needs few of them. The number of
phrases, times the logarithm of the automaton's text length, per character, estimates the cross entropy, and
the language with the least wins.

Automata are trained on whole texts of at most ``SAMPLE_ROWS`` labelled rows per language, no longer than
``SAMPLE_TEXT`` characters each and ``SAMPLE_CHARS`` codes in all, divided among the languages. That bounds what the
driver gathers and what a task holds. Prediction covers every character of every text: texts are laid end to end,
cut into blocks, and all blocks of a batch take their steps through all automata side by side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import ship, whole

SAMPLE_ROWS = 64
SAMPLE_TEXT = 20_000
SAMPLE_CHARS = 160_000
# Codes that a parse may see: a blank, padding, digits, and the most frequent letters. Every other letter is spelled
# with digits, so that none is lost.
ALPHABET = 96
DIGIT_BITS, DIGITS = 4, 5
BLOCK = 256
STEP_CHARS = 1 << 20
UNDETERMINED = "und"

_SPACE, _SPELLED, _PAD = 0, 1, 2
_DIGIT = 3
_CODES = _DIGIT + (1 << DIGIT_BITS)


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its lower-case form (0 for all that is no letter)."""
    lower = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            small = char.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    return lower > 0, lower


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def normalise(text: str) -> np.ndarray:
    """Lower-case letters, with a single 0 for each run of anything else, and one at either end."""
    lowered = _folding()[1][_points(f" {text} ")]
    keep = np.ones(len(lowered), dtype=bool)
    keep[1:] = (lowered[1:] > 0) | (lowered[:-1] > 0)
    return lowered[keep]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that knows every substring of ``codes``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = state
            at = link[at]
        if at >= 0:
            target = moves[at][code]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(code) == target:
                    moves[at][code] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


class Parser:
    """Automata of all languages as one table of steps; the lowest bit of a step tells that a phrase began."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts, key=str.encode)
        streams = [np.concatenate([normalise(text) for text in texts[one]]) for one in self.languages]
        points, counts = np.unique(np.concatenate(streams), return_counts=True)
        common = points[points > 0][np.argsort(-counts[points > 0], kind="stable")][: ALPHABET - _CODES]
        self.code = np.full(0x110000, _SPELLED, dtype=np.uint8)
        self.code[0] = _SPACE
        self.code[common] = np.arange(_CODES, _CODES + len(common), dtype=np.uint8)
        width = _CODES + len(common)
        tables, self.starts, self.costs, base = [], [], [], 0
        for stream in streams:
            codes = self.spell(stream)[: SAMPLE_CHARS // len(streams)]
            moves = suffix_automaton(codes.tolist())
            table = np.full((len(moves), width), -1, dtype=np.int32)
            for state, out in enumerate(moves):
                table[state, list(out)] = list(out.values())
            first = np.where(table[0] >= 0, table[0], 0)
            begins = table < 0
            # 32 bits hold a step: the sample bounds the states.
            step = (np.where(begins, first[None, :], table) + np.int32(base)) * np.int32(2 * width) + begins
            step[:, _PAD] = (np.arange(len(moves)) + base) * (2 * width)  # padding neither moves nor counts
            tables.append(step.astype(np.int32))
            self.starts.append(base * width)
            self.costs.append(math.log2(len(codes) + 2))
            base += len(moves)
        self.steps = np.concatenate(tables).ravel()

    def spell(self, points: np.ndarray) -> np.ndarray:
        """The codes of normalised letters: one each, or ``DIGITS`` digits for a letter without a code of its own."""
        codes = self.code[points]
        rare = codes == _SPELLED
        if not rare.any():
            return codes
        width = np.where(rare, DIGITS, 1)
        spelled, at = np.repeat(codes, width), (np.cumsum(width) - width)[rare]
        for place in range(DIGITS):
            digit = (points[rare] >> np.uint32(DIGIT_BITS * (DIGITS - 1 - place))) & np.uint32((1 << DIGIT_BITS) - 1)
            spelled[at + place] = _DIGIT + digit
        return spelled

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases of each block (rows) in each language (columns)."""
        state = np.tile(np.array(self.starts, dtype=np.int64), (len(blocks), 1))
        count = np.ones(state.shape, dtype=np.int64)
        for column in np.ascontiguousarray(blocks.T).astype(np.int64):
            step = self.steps[state + column[:, None]].astype(np.int64)
            count += step & 1
            state = step >> 1
        return count

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language and a score (the runner-up's distance, 0 to 1) for each text."""
        streams = [self.spell(normalise(text)) for text in texts]
        sizes = np.array([-(-len(s) // BLOCK) for s in streams])
        blocks = np.full((int(sizes.sum()), BLOCK), _PAD, dtype=np.uint8)
        flat, at = blocks.ravel(), 0
        for stream, size in zip(streams, sizes):
            flat[at : at + len(stream)] = stream
            at += size * BLOCK
        count = np.add.reduceat(self.phrases(blocks), np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        entropy = count * np.array(self.costs) / np.array([len(s) for s in streams])[:, None]
        best = entropy.argmin(axis=1)
        ordered = np.sort(entropy, axis=1)
        runner = ordered[:, 1] if ordered.shape[1] > 1 else np.maximum(ordered[:, 0], math.log2(ALPHABET))
        score = np.clip(1 - ordered[:, 0] / runner, 0, 1)
        return [self.languages[i] for i in best], score.tolist()


@lru_cache(maxsize=2)
def _parser(sample: tuple[tuple[str, tuple[str, ...]], ...]) -> Parser:
    return Parser({language: list(texts) for language, texts in sample})


def draw_sample(
    labelled: DataFrame, doc_id="doc_id", text="text", lang="lang", rows=SAMPLE_ROWS, longest=SAMPLE_TEXT,
    chars=SAMPLE_CHARS,
) -> dict[str, list[str]]:
    """Whole texts per language from a bounded number of labelled rows, drawn by the hash of the id.

    One row is drawn per language and hash slot, found by an aggregate that is combined before its shuffle, so
    a language that has most rows costs no more than the others.
    """
    rows_of = labelled.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows_of.where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.char_length("text") <= longest)
    ).withColumn("draw", F.xxhash64(F.col("id").cast("string"), "text"))
    slots = usable.groupBy("lang", F.pmod("draw", F.lit(rows)).alias("slot")).agg(F.min("draw").alias("draw"))
    # One row per language and slot.
    wanted = F.broadcast(slots.select("lang", "draw"))
    drawn = usable.join(wanted, ["lang", "draw"], "left_semi").dropDuplicates(["lang", "draw"]).collect()
    drawn.sort(key=lambda row: (row["lang"], row["draw"]))
    languages = {row["lang"] for row in drawn}
    texts: dict[str, list[str]] = {}
    for language in languages:
        left = chars // len(languages)
        for row in drawn:
            if row["lang"] == language and (len(row["text"]) <= left or language not in texts):
                texts.setdefault(language, []).append(row["text"])
                left -= len(row["text"])
    return texts


def predict(docs: DataFrame, sample: dict[str, list[str]], doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, lang_pred, score per row of ``docs``.

    A null text and a text without a letter are ``und`` with score 0, as is everything without a sample.
    Equal entropies go to the language that sorts first. Nothing but the text enters a prediction.
    """
    ship(docs.sparkSession)
    learned = tuple((language, tuple(texts)) for language, texts in sorted(sample.items()))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _folding()[0]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            waiting, size = [], 0
            for i, body in enumerate(texts):
                if learned and letters[_points(body)].any():
                    waiting.append(i)
                    size += len(body)
                if waiting and (size >= STEP_CHARS or i + 1 == len(texts)):
                    for k, language, score in zip(waiting, *_parser(learned).predict([texts[j] for j in waiting])):
                        languages[k], scores[k] = language, score
                    waiting, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
