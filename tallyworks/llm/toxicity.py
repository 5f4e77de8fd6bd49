"""Toxicity of texts whose words may be disguised.

A noisy channel stands between the words and the text: digits and signs for letters, letters set
apart, letters repeated. Suspicious tokens become lattices of the letters they may stand for, and
the best path under a character language model (four letters, interpolated, counted over every document of the
corpus) restores them. The restored text is scored by words and word beginnings whose
log-odds were learned from at most ``SAMPLE`` labelled rows, those with the smallest hash of their doc_id.

The model of letters has a fixed alphabet (a to z without accents, other letters, the space), so it is bounded
at 28 ** 4 numbers, while its counts cover the whole corpus. Of the learned words at most ``LEXICON`` with
the largest weights are kept.

Nulls and odd cases: a null or empty text has the prior's score; rows without a label or doc_id are never
learned from; a document with several labels counts once for each; repeated rows are scored each. Without labels every score is
that of an even prior.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

ORDER = 4
SYMBOLS = 28
OTHER = 27
SMOOTHING = 5.0
LEXICON = 20_000
# The lexicon is learned from at most so many labelled rows.
SAMPLE = 20_000
LEAST_DOCUMENTS = 5
LEAST_WEIGHT = 3.5
BEGINNINGS = (5, 6, 7)
STRONGEST = 3
# A task hands its counts on when it holds so many features.
FLUSH = 300_000

# Letters that a sign may stand for, and what each reading costs in log-probability.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "*": "aeiou"}
SIGN_COST, BREAK_COST = -1.0, -6.0
# What a sign that is also punctuation costs as such, at either end of a token.
EDGE_COST, EDGE = -2.0, "!*+|$"
_SINGLE = r"(?<![^\W_])(?:[^\W\d_]|[01345789@$!+|*])(?![^\W_])"
# Three or more single letters or signs, parted by spaces or punctuation; or a sign beside a letter; or a letter three times.
SUSPICIOUS = re.compile(
    rf"(?P<apart>{_SINGLE}(?:(?:[^\w@$!+]|_){{1,3}}{_SINGLE}){{2,}})"
    r"|[^\W\d_][01345789@$!+|*]"
    r"|[01345789@$!+|*][^\W\d_]"
    r"|([^\W\d_])\2\2"
    r"|[^\W\d_](?:[._~*-][^\W\d_]){2,}"
)
APART = re.compile(r"(?:[^\w@$!+]|_)+")
WORD = re.compile(r"[^\W\d_]+")
# The classes of characters in SUSPICIOUS, as bits.
LETTER, SIGN, JOINT, INNER = 1, 2, 4, 8
CLASSES = {LETTER: r"[^\W\d_]", SIGN: r"[01345789@$!+|*]", JOINT: r"[._~*-]", INNER: r"[^\W_]"}
# Letters are counted when a task has so many codes.
COUNTED = 1_000_000


@lru_cache(maxsize=1)
def _slots() -> np.ndarray:
    """The symbol of each code point: 0 for what is no letter, 1 to 26 for a to z with or without accent."""
    slots = np.zeros(0x110000, np.int8)
    for point in range(0x110000):
        if chr(point).isalpha():
            base = unicodedata.normalize("NFKD", chr(point).lower())[0] if point < 0x250 else ""
            slots[point] = ord(base) - 96 if "a" <= base <= "z" else OTHER
    return slots


def symbols(text: str) -> np.ndarray:
    """A text as symbols, with one space for each run of other characters and at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = np.zeros(len(points) + 2, np.int32)
    found[1:-1] = _slots()[points]
    return found[(found > 0) | np.concatenate(([True], found[:-1] > 0))]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The classes of each code point."""
    classes, points = np.zeros(0x110000, np.uint8), "".join(map(chr, range(0x110000)))
    for bit, pattern in CLASSES.items():
        for run in re.finditer(f"{pattern}+", points):
            classes[run.start() : run.end()] |= bit
    return classes


def starts(text: str) -> list[int]:
    """Where SUSPICIOUS may match, by the first characters of its branches; all its matches begin at one of these places."""
    n, points = len(text), np.frombuffer(f" {text}    ".encode("utf-32-le", "surrogatepass"), "<u4")
    classes = _classes()[points]
    letter, sign, joint, inner = (classes & bit > 0 for bit in CLASSES)
    single = letter | sign
    single[1:-1] &= ~(inner[:-2] | inner[2:])
    ahead = lambda found, by: found[1 + by : 1 + by + n]
    twice = letter[:-1] & (points[:-1] == points[1:])
    joined = letter[:-2] & joint[1:-1] & letter[2:]
    found = ahead(letter, 0) & ahead(sign, 1) | ahead(sign, 0) & ahead(letter, 1)
    found |= ahead(twice, 0) & ahead(twice, 1) | ahead(joined, 0) & ahead(joined, 2)
    found |= ahead(single, 0) & (ahead(single, 2) | ahead(single, 3) | ahead(single, 4))
    return np.flatnonzero(found).tolist()


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, codes, held = np.zeros(SYMBOLS**ORDER, np.int64), [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            s = np.concatenate((np.zeros(ORDER - 2, np.int32), symbols(text or "")))
            if len(s) >= ORDER:
                code = s
                for i in range(1, ORDER):
                    code = code[:-1] * SYMBOLS + s[i:]
                codes.append(code)
                held += len(code)
            if held > COUNTED:
                total += np.bincount(np.concatenate(codes), minlength=SYMBOLS**ORDER)
                codes, held = [], 0
    if codes:
        total += np.bincount(np.concatenate(codes), minlength=SYMBOLS**ORDER)
    code = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of each symbol after the three before it, from the counts of all documents."""
    common.ship(docs.sparkSession)
    counts = docs.select("text").mapInArrow(_grams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    # At most 28 ** 4 rows, whatever the input.
    table, n = counts.toArrow(), np.zeros(SYMBOLS**ORDER)
    n[table["code"].to_numpy()] = table["n"].to_numpy()
    n = n.reshape([SYMBOLS] * ORDER)
    probability = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        level = n.sum(axis=tuple(range(ORDER - order))) if order < ORDER else n
        context = level.sum(-1, keepdims=True)
        probability = (level + SMOOTHING * probability) / (context + SMOOTHING)
    return np.log(probability).astype(np.float32)


def lattice(token: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """What each part of a token may stand for, with costs. What parts single letters (``apart``) may stand for nothing."""
    parts, at = [], 0
    inner = [i for i, c in enumerate(token) if c.isalpha() or c in SIGNS and c not in EDGE]
    while at < len(token):
        parting = APART.match(token, at) if apart else None
        if parting:
            parts.append([("", 0.0), (" ", BREAK_COST)])
            at = parting.end()
            continue
        c, run = token[at], at
        while run < len(token) and token[run] == c:
            run += 1
        if c.isalpha():
            count = run - at
            parts += [[(c, 0.0)]] * count if count < 3 else [[(c, 0.0), (c + c, 0.0)]]
        elif c in SIGNS:
            outside = c in EDGE and inner and not inner[0] < at < inner[-1]
            readings = [(x, SIGN_COST) for x in SIGNS[c]] + [(" ", EDGE_COST if outside else BREAK_COST)]
            parts += [readings] * (run - at)
        elif c in "._~-":
            parts.append([("", SIGN_COST), (" ", 0.0)])
        else:
            parts.append([(" ", 0.0)])
        at = run
    return parts


def decode(token: str, model: np.ndarray, apart: bool = False) -> str:
    """The best path through a token's lattice; a state is the last three symbols."""
    slots, best = _slots(), {(0, 0, 0): (0.0, None)}
    for part in lattice(token, apart):
        after: dict[tuple, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for reading, cost in part:
                now, total, walked = state, score + cost, path
                for c in reading:
                    s = int(slots[ord(c)])
                    if s or now[-1]:
                        total += float(model[now + (s,)])
                        now = now[1:] + (s,)
                    walked = (c, walked)
                if now not in after or total > after[now][0]:
                    after[now] = (total, walked)
        best = after
    ends = {s: (score + (float(model[s + (0,)]) if s[-1] else 0.0), path) for s, (score, path) in best.items()}
    path, letters = max(ends.values(), key=lambda x: x[0])[1], []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


class Restorer:
    """Restores the suspicious tokens of texts; equal tokens are decoded once."""

    def __init__(self, model: np.ndarray, remembered: int = 100_000) -> None:
        self.decode = lru_cache(maxsize=remembered)(lambda token, apart: decode(token, model, apart))

    def __call__(self, text: str | None) -> str:
        text = (text or "").lower()
        parts, done = [], 0
        for at in starts(text):
            hit = SUSPICIOUS.match(text, at) if at >= done else None
            if not hit:
                continue
            start, stop = hit.span()
            apart = hit["apart"] is not None
            if apart and sum(map(str.isalpha, hit["apart"])) < 2:
                # Numbers in a row.
                parts.append(text[done:stop])
                done = stop
                continue
            while not apart and start > done and not text[start - 1].isspace():
                start -= 1
            while not apart and stop < len(text) and not text[stop].isspace():
                stop += 1
            parts += [text[done:start], self.decode(text[start:stop], apart)]
            done = stop
        return "".join([*parts, text[done:]])


def features(word: str) -> Iterable[str]:
    """A word and its beginnings, which are marked."""
    yield word
    for n in BEGINNINGS:
        if len(word) > n:
            yield "^" + word[:n]


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Weights of the telling features, and the log-odds of the prior, from at most ``sample`` (doc_id, toxic) labels."""
    common.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, found = Restorer(shared.value), {}

        def rows() -> pa.RecordBatch:
            names, n = list(found), np.array(list(found.values()), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n[:, 0]), pa.array(n[:, 1])], ["feature", "without", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(restore(text)))
                for f in {f for w in words for f in features(w)} | {""}:
                    found.setdefault(f, [0, 0])[toxic] += 1
            if len(found) > FLUSH:
                yield rows()
                found = {}
        yield rows()

    known = labels.filter("doc_id is not null and toxic in (0, 1)").select("doc_id", "toxic")
    # Written, so that the tasks' candidates meet in a task and not in the driver.
    chosen = common.written(known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample), "sample")
    # Bounded by the sample, so no text is shuffled.
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int"))
    counts = rows.mapInArrow(count, "feature string, without long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("without").alias("without"), F.sum("toxic").alias("toxic"))
    counts = common.written(counts.filter((F.col("toxic") >= LEAST_DOCUMENTS) | (F.col("feature") == "")), "features")
    totals = counts.filter("feature = ''").first()
    negatives, positives = (totals["without"], totals["toxic"]) if totals else (0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (positives + 1)) - F.log((F.col("without") + 0.5) / (negatives + 1))
    told = counts.filter("feature != ''").select("feature", weight.alias("weight")).filter(F.col("weight") >= LEAST_WEIGHT)
    kept = told.orderBy(F.desc("weight"), "feature").limit(LEXICON).collect()
    return {r["feature"]: r["weight"] for r in kept}, math.log((positives + 1) / (negatives + 1))


def score(docs: DataFrame, model: np.ndarray, lexicon: dict[str, float], prior: float) -> DataFrame:
    """(doc_id, score, restored): the probability, and how many tokens were restored to a telling word."""
    common.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, lexicon))

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, lexicon = shared.value
        restore, weights = Restorer(model), lru_cache(maxsize=300_000)(lambda w: max([0.0, *(lexicon.get(f, 0.0) for f in features(w))]))
        for texts in batches:
            out = []
            for text in texts:
                found = [weights(w) for w in set(WORD.findall(restore(text)))]
                total = prior + sum(sorted(found)[-STRONGEST:])
                out.append(1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, total)))))
            yield pd.Series(out, dtype="float64")

    return docs.select("doc_id", judge("text").alias("score"))
