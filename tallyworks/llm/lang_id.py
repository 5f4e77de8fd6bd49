"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of three letters in a row binds, by
elementwise product, the first rotated by two places, the second by one, and the third. A text is the bundle, that is the sum,
of its trigram vectors, words being set off by a space; a language's prototype is the bundle of its learning texts.
A text gets the language whose prototype has the largest cosine with it.

Bundling is a sum, so prototypes add up: each task bundles the trigram counts of its rows per
language, and the vectors of the tasks are summed by a grouped aggregation. All learning rows count.

Nulls and odd cases: a null text, or one without any letter, is ``und`` with score 0; rows with a null
language are never learned from; equal cosines go to the language that sorts first; repeated
rows count as often as they occur. Without any learning row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

DIMENSIONS = 1024
# Letters share this many random vectors by code point; slot 0 is the space between words.
LETTERS = 1024
SEED = 7
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letter vectors as they are bound at the first, second and third place."""
    base = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS), np.int8) * 2 - 1
    return np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base


@lru_cache(maxsize=1)
def _slots() -> np.ndarray:
    """The slot of each code point: 0 for what is no letter."""
    slots = np.zeros(0x110000, np.int16)
    for point in range(0x110000):
        if chr(point).isalpha():
            slots[point] = 1 + point % (LETTERS - 1)
    return slots


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the distinct trigrams of a text, and their counts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    slots = np.concatenate(([0], _slots()[points], [0])).astype(np.int64)
    # Runs of other characters become a single space.
    slots = slots[(slots > 0) | np.r_[True, slots[:-1] > 0]]
    if len(slots) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = (slots[:-2] * LETTERS + slots[1:-1]) * LETTERS + slots[2:]
    # A trigram with the space in the middle joins two words and says nothing.
    codes = codes[slots[1:-1] > 0]
    return np.unique(codes, return_counts=True)


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the trigrams' vectors, each as often as counted."""
    first, second, third = _letter_vectors()
    total = np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(codes), 4096):
        part = codes[at : at + 4096]
        bound = first[part // LETTERS**2] * second[part // LETTERS % LETTERS] * third[part % LETTERS]
        total += counts[at : at + 4096].astype(np.float32) @ bound.astype(np.float32)
    return total


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language, the sum of the vectors of a task's rows; texts with equal trigrams are bundled at once."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        kept: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            kept.setdefault(lang, []).append(trigrams(text))
        for lang, found in kept.items():
            codes, where = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in found]), len(codes))
            sums[lang] = sums.get(lang, 0.0) + bundle(codes, counts).astype(np.float64)
    for lang, vector in sums.items():
        columns = [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS)), pa.array(vector)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "place", "value"])


def prototypes(rows: DataFrame) -> DataFrame:
    """(lang, place, value): the prototype of every language of the learning rows (lang, text)."""
    common.ship(rows.sparkSession)
    rows = rows.filter("lang is not null").select("lang", "text")
    sums = rows.mapInArrow(_bundled, "lang string, place long, value double")
    return sums.groupBy("lang", "place").agg(F.sum("value").alias("value"))


def predict(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score) for each row. The profiles are as many as there are languages."""
    common.ship(docs.sparkSession)
    table = profiles.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).orderBy("lang").collect()
    names = [r["lang"] for r in table]
    matrix = np.array([[x["value"] for x in r["v"]] for r in table], np.float32).reshape(len(names), DIMENSIONS)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            codes, counts = trigrams(text)
            if not len(codes) or not names:
                found.append((UNKNOWN, 0.0))
                continue
            vector = bundle(codes, counts)
            cosines = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-30)
            best = int(np.argmax(cosines))
            found.append((names[best], float(np.clip(cosines[best], 0.0, 1.0))))
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.select("doc_id", nearest(F.col("text")).alias("p")).select("doc_id", "p.*")
