"""Language of texts by string kernels.

A text is the set of its character n-grams of 1 to 4 letters (a blended spectrum, presence only). n-grams are hashed to
SLOTS slots. The kernel of two texts is the number of slots they share over the root of the product of their own
numbers. Kernel ridge regression, one language against the rest, runs on the kernel's values at a few landmark texts
(Nystroem); scoring is a product of a batch's presence matrix with the landmarks' and then with the weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import text_blocks, without

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
SLOTS = 1 << 18
#: Bounds of the fit: texts learned from and landmarks among them, for each language; languages, texts and landmarks in all.
#: Of more languages the most frequent ones are learned, and many languages share what texts and landmarks there are.
TEXTS_PER_LANGUAGE = 200
LANDMARKS_PER_LANGUAGE = 24
MOST_LANGUAGES = 128
MOST_TEXTS = 12_800
MOST_LANDMARKS = 1_024
#: A text scores too low for its language if it does not reach this share of what the middle one of those learned from has.
LEAST_SHARE = 0.42
RIDGE = 1e-3
#: Texts scored by one product.
BATCH = 64

PREDICTION = T.StructType([T.StructField("lang", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])


def _letter_table() -> np.ndarray:
    """Lower-case code point of each letter, else 0."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        letter = chr(c)
        if letter.isalpha():
            lower = letter.lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


class Spectrum:
    """Turns texts into the slots of their n-grams; everything but letters is a blank."""

    def __init__(self):
        self.letters = _letter_table()

    def codes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters of all texts with one blank before each text, and where each text begins."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        counts = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=counts[1:])
        bounds = counts[offsets]
        return np.insert(self.letters[points], bounds[:-1], 0), bounds + np.arange(len(bounds))

    @staticmethod
    def slots(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each order the slot of the n-gram at every place; n-grams that begin or go on behind a blank count as such."""
        mixed = codes * np.uint32(0x9E3779B1)
        running = mixed
        yield 1, running >> np.uint32(14)
        for n in ORDERS[1:]:
            running = (running[:-1] ^ (running[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + mixed[n - 1 :]
            yield n, running >> np.uint32(14)

    def presence(self, codes: np.ndarray, bounds: np.ndarray, slot_columns: np.ndarray, width: int) -> np.ndarray:
        """Texts by columns, one where a text has an n-gram of that column; n-grams never cross texts."""
        n = len(bounds) - 1
        seen = np.zeros(n * width, bool)
        row = np.repeat(np.arange(n) * width, np.diff(bounds))
        last = np.repeat(bounds[1:], np.diff(bounds))
        for order, slots in self.slots(codes):
            m = len(slots)
            column = slot_columns[slots]
            use = (column >= 0) & (np.arange(m) + order <= last[:m])
            seen[row[:m][use] + column[use]] = True
        return seen.reshape(n, width)


_SPECTRUM: list[Spectrum] = []


def spectrum() -> Spectrum:
    if not _SPECTRUM:
        _SPECTRUM.append(Spectrum())
    return _SPECTRUM[0]


ALL_SLOTS = np.arange(SLOTS, dtype=np.int32)


@dataclass
class LanguageModel:
    languages: list[str]
    columns: np.ndarray  # column of each slot, or -1
    landmarks: np.ndarray  # columns by landmarks: presence over the root of the landmark's own number
    weights: np.ndarray  # landmarks by languages
    bias: np.ndarray
    usual: np.ndarray  # of each language, the middle score of the texts learned from

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of a block."""
        known = spectrum()
        codes, bounds = known.codes(data, offsets)
        names, scores = [], []
        for a in range(0, len(bounds) - 1, BATCH):
            b = min(a + BATCH, len(bounds) - 1)
            part, at = codes[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            seen = known.presence(part, at, self.columns, self.landmarks.shape[0]).astype(np.float32)
            own = np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))
            values = (seen @ self.landmarks) / own @ self.weights + self.bias
            best = values.argmax(axis=1)
            letters = np.add.reduceat((part > 0).astype(np.int64), at[:-1]) > 0 if b > a else np.zeros(0, bool)
            top = np.clip(values[np.arange(b - a), best], 0, 1)
            names += [self.languages[i] if ok and self.languages else UNKNOWN for i, ok in zip(best, letters)]
            scores.append(np.where(letters, top, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def sample_rows(df: DataFrame, id: Column, lang: Column, text: Column, per_language: int) -> DataFrame:
    """Up to so many rows of each of the MOST_LANGUAGES most frequent languages, those of the smallest hash of id and language.

    The hashes are chosen without reading a text.
    """
    rows = df.select(lang.alias("lang"), F.xxhash64(id, lang).alias("draw"), text.alias("text")).filter("lang is not null and text is not null")
    learned = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    per_language = max(1, min(per_language, MOST_TEXTS // max(1, len(learned))))
    rows = rows.filter(F.col("lang").isin(learned))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = rows.select("lang", "draw").withColumn("place", place).filter(F.col("place") <= per_language)
    upto = chosen.groupBy("lang").agg(F.max("draw").alias("draw")).collect()
    limit = F.lit(None).cast("long")
    if upto:
        limit = F.create_map(*[F.lit(v) for r in upto for v in (r["lang"], r["draw"])])[F.col("lang")]
    # Repeated rows have one hash and are learned from once.
    return rows.filter(F.col("draw") <= limit).groupBy("lang", "draw").agg(F.min("text").alias("text"))


def fit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id: str = "doc_id",
    per_language: int = TEXTS_PER_LANGUAGE,
    landmarks_per_language: int = LANDMARKS_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the rows that have a language and a text, at most per_language of each language.

    The driver gets the slots of those texts only. Without any such row the model predicts `und` everywhere.
    """
    rows = sample_rows(df, df[f"`{id}`"], df[f"`{lang}`"], df[f"`{text}`"], per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = spectrum()
        for batch in batches:
            lists = []
            for data, offsets in text_blocks(batch.column(2)):
                codes, bounds = known.codes(data, offsets)
                for a, b in zip(bounds, bounds[1:]):
                    seen = known.presence(codes[a:b], np.array([0, b - a]), ALL_SLOTS, SLOTS)
                    lists.append(np.flatnonzero(seen[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["lang", "draw", "slots"])

    got = rows.mapInArrow(run, "lang string, draw long, slots array<int>").toArrow()
    order = sorted(range(got.num_rows), key=lambda i: (got["lang"][i].as_py(), got["draw"][i].as_py()))
    names = [got["lang"][i].as_py() for i in order]
    slots = [np.asarray(got["slots"][i].values) for i in order]
    languages = sorted(set(names))
    if not languages:
        return LanguageModel([], np.full(SLOTS, -1, np.int32), np.zeros((1, 1), np.float32), np.zeros((1, 1), np.float32), *[np.zeros(1, np.float32)] * 2)
    landmarks_per_language = max(1, min(landmarks_per_language, MOST_LANDMARKS // len(languages)))
    marks, taken = [], dict.fromkeys(languages, 0)
    for i, name in enumerate(names):
        if taken[name] < landmarks_per_language and len(slots[i]):
            taken[name] += 1
            marks.append(i)
    marks = marks or [0]
    used = np.unique(np.concatenate([slots[i] for i in marks])) if any(len(slots[i]) for i in marks) else np.zeros(1, np.int64)
    columns = np.full(SLOTS, -1, np.int32)
    columns[used] = np.arange(len(used))
    seen = np.zeros((len(order), len(used)), np.float32)
    for i, own in enumerate(slots):
        at = columns[own]
        seen[i, at[at >= 0]] = 1
    # Landmarks and texts are scaled by the slots they have among those of the landmarks.
    scaled = seen / np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))
    kernel = (scaled @ scaled[marks].T).astype(np.float64)
    between = kernel[marks]
    target = np.array([[name == x for x in languages] for name in names], np.float64)
    bias = target.mean(axis=0)
    left = kernel.T @ kernel + RIDGE * len(order) * between + 1e-9 * len(order) * np.eye(len(marks))
    weights = np.linalg.solve(left, kernel.T @ (target - bias))
    own = (kernel @ weights + bias)[target > 0]
    usual = np.array([np.median(own[[name == x for name in names]]) for x in languages], np.float32)
    return LanguageModel(languages, columns, scaled[marks].T.copy(), weights.astype(np.float32), bias.astype(np.float32), usual)


def predicted(text: Column, model: LanguageModel, df: DataFrame) -> Column:
    """A struct (lang, score): a learned language, or `und` with score 0 for null texts and texts without a letter.

    The score is the regression's value for the language, cut to 0 to 1. Whole texts are read; equal texts get equal
    predictions.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for block in text_blocks(texts):
            own, values = shared.value.score(*block)
            names += own
            scores.append(values)
        values = np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values)], names=["lang", "score"])

    return predict(F.coalesce(text, F.lit("")))


def sure(guess: Column, model: LanguageModel, least_share: float = LEAST_SHARE) -> Column:
    """Whether a prediction is a language whose score is at least so large a share of what that language's texts usually have."""
    known = F.lit(False)
    for language, usual in zip(model.languages, model.usual.tolist()):
        known = F.when(guess["lang"] == language, guess["score"] >= least_share * usual).otherwise(known)
    return known


def with_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The table with `lang_pred` and `score`; columns of these names are replaced."""
    df = without(df, "lang_pred", "score")
    names = [f"`{c}`" for c in df.columns]
    guess = df.select(*names, predicted(df[f"`{text}`"], model, df).alias("_guess"))
    return guess.select(*names, F.col("_guess.lang").alias("lang_pred"), F.col("_guess.score").alias("score"))


def held_out(id: Column) -> Column:
    """Documents never learned from, by their id alone."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
