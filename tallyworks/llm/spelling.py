"""Spelling variants grouped by pivotal grams.

Two words are near if one inserted, deleted or replaced character separates them. All bigrams get a
global order, rare ones first. A word's prefix is its three first bigrams in that order, with all
others that equal the third; among them two that do not overlap are chosen as pivots, by dynamic
programming over positions, so that their lists are short. One edit touches at most one of two disjoint
bigrams. So if the last bigram of s's prefix does not come after that of r's, some pivot of s stands
in r's prefix, where the edit can have moved it by at most one place. The pivots are therefore looked up in an
index of the prefixes by bigram, place and length, the five ways in which one edit can leave
them, and each pair that meets is verified by its edit distance. Nothing is sampled or capped.

The order needs no more than a table of 65,536 numbers, since bigrams are counted by a hash class; ties go by
text. Index lists of very many words are split, and the pivots looked up in each part. At most
``MAX_HOT`` lists can be over the bound at which that starts, so their sizes are broadcast.

Odd cases: null and empty texts and those without a letter run have no words; a null doc_id is like any
other; repeated rows count each time; words of one text only, ties and empty tables are as the formulas
say; a word of very many characters has many bigrams, in one row. Words of under ``LEAST`` characters are
not accepted. Columns of other names in the tables are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

# Fixed value: letters of a word, as the contract has them.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GRAM = 2
EDITS = 1
PREFIX = GRAM * EDITS + 1
# Words of this length have as many bigrams as a prefix.
LEAST = PREFIX + GRAM - 1
CLASSES = 1 << 16
# Lists of more words than this are split; there can be at most MAX_HOT of them.
LIST = 2_000
MAX_HOT = 50_000

GRAMS = "array<struct<gram:string,place:int>>"
KEYS_SCHEMA = f"word string, n long, letters long, last_count long, last_gram string, prefix {GRAMS}, pivots {GRAMS}"


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters of every whole text, A to Z lower-cased."""
    runs = F.regexp_extract_all("text", F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def count_words(runs: DataFrame, word: Column, least_chars: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n): the words that are long and frequent enough, with their occurrences; added up before the shuffle."""
    counted = runs.select(word.alias("word")).filter(F.char_length("word") >= least_chars)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def gram_class(gram: str) -> int:
    return zlib.crc32(gram.encode()) % CLASSES


def class_counts(words: DataFrame) -> dict[int, int]:
    """Bigrams of all words counted by hash class: at most CLASSES rows, whatever the alphabet."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    kind = (F.crc32(F.col("gram").cast("binary")) % CLASSES).cast("int").alias("kind")
    return {row["kind"]: row["count"] for row in grams.groupBy(kind).count().collect()}


def choose_pivots(prefix: Sequence[tuple[int, str, int]], count: int = EDITS + 1) -> list[tuple[int, str, int]]:
    """The ``count`` bigrams of a prefix that do not overlap and have the least sum of list lengths.

    ``prefix`` holds (list length, gram, place). ``best[k][i]`` is the cheapest choice of k among the
    first i in order of place; each bigram is left out, or taken after the last one that ends before it.
    """
    grams = sorted(prefix, key=lambda g: g[2])
    best: list[list[tuple[int, tuple] | None]] = [[(0, ())] * (len(grams) + 1)]
    for k in range(count):
        row, free = [None], 0
        for i, gram in enumerate(grams):
            while free < i and grams[free][2] + GRAM <= gram[2]:
                free += 1
            before, left_out = best[k][free], row[-1]
            taken = before and (before[0] + gram[0], (*before[1], gram))
            row.append(taken if taken and (left_out is None or taken[0] < left_out[0]) else left_out)
        best.append(row)
    return list(best[count][-1][1])


def word_keys(word: str, counts: dict[int, int]) -> tuple[tuple[int, str], list, list]:
    """(last of the prefix, prefix, pivots) of a word of at least LEAST characters."""
    grams = [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]
    ranked = sorted((counts.get(gram_class(g), 0), g, place) for place, g in enumerate(grams))
    last = ranked[PREFIX - 1][:2]
    prefix = [g for g in ranked if g[:2] <= last]
    return last, prefix, choose_pivots(prefix)


def letter_bits(word: str) -> int:
    """The set of a word's characters in 63 bits: one edit takes at most one bit away and adds at most one."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def keyed(words: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Every word with its prefix, the last bigram of it in the order, and its pivots."""
    common.ship(words.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(word) < LEAST:
                    raise ValueError(f"words need {LEAST} characters, not {word!r}")
                last, prefix, pivots = word_keys(word, counts)
                lists = [[{"gram": g, "place": place} for _, g, place in part] for part in (prefix, pivots)]
                out.append((word, n, letter_bits(word), *last, *lists))
            columns = list(zip(*out)) if out else [()] * len(NAMES)
            gram = pa.list_(pa.struct([("gram", pa.string()), ("place", pa.int32())]))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), gram, gram]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)

    return words.select("word", "n").mapInArrow(rows, KEYS_SCHEMA)


NAMES = ["word", "n", "letters", "last_count", "last_gram", "prefix", "pivots"]
KEY = ["gram", "place", "size"]


def _lookups(keys: DataFrame) -> DataFrame:
    """The pivots, each at the places and lengths that one edit can leave it."""
    # Shift of the place and of the length for a replaced, deleted or inserted character.
    ways = [(0, 0), (0, -1), (-1, -1), (0, 1), (1, 1)]
    each = keys.select("word", "n", "letters", "last_count", "last_gram", F.explode("pivots").alias("pivot"))
    left = F.explode(F.array(*[F.struct(F.lit(p).alias("place"), F.lit(s).alias("size")) for p, s in ways])).alias("way")
    return each.select("*", left).select(
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        F.col("letters").alias("a_letters"),
        F.struct("last_count", "last_gram").alias("a_last"),
        F.col("pivot.gram").alias("gram"),
        (F.col("pivot.place") + F.col("way.place")).alias("place"),
        (F.char_length("word") + F.col("way.size")).alias("size"),
    )


def _index(keys: DataFrame) -> DataFrame:
    entry = F.explode("prefix").alias("entry")
    return keys.select("word", "n", "letters", "last_count", "last_gram", entry).select(
        F.col("word").alias("b"),
        F.col("n").alias("b_n"),
        F.col("letters").alias("b_letters"),
        F.struct("last_count", "last_gram").alias("b_last"),
        F.col("entry.gram").alias("gram"),
        F.col("entry.place").alias("place"),
        F.char_length("word").alias("size"),
    )


def _hot_lists(index: DataFrame) -> DataFrame:
    """Index lists over the bound and the parts to split them into.

    The bound is at least one MAX_HOT-th of all entries, so there are at most MAX_HOT such lists.
    """
    sizes = common.written(index.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), "gram-lists")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bound = max(LIST, -(-total // MAX_HOT))
    return sizes.filter(F.col("n") > bound).select(*KEY, F.ceil(F.col("n") / bound).cast("int").alias("parts"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), both ways, of all words (word, n) that one edit separates; ``word`` is distinct."""
    keys = common.written(keyed(words, class_counts(words)), "word-keys")
    index, hot = _index(keys), F.broadcast(_hot_lists(_index(keys)))
    parts = F.coalesce("parts", F.lit(1))
    entries = index.join(hot, KEY, "left").withColumn("part", F.pmod(F.xxhash64("b"), parts).cast("int")).drop("parts")
    lookups = _lookups(keys).join(hot, KEY, "left")
    lookups = lookups.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    meet = [lookups[k] == entries[k] for k in (*KEY, "part")]
    first = F.col("a_last") <= F.col("b_last")
    letters = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2 * EDITS
    alike = F.levenshtein(F.col("a"), F.col("b"), EDITS) == 1
    ends = [(F.col(x), F.col(f"{x}_n")) for x in ("a", "b")]
    low = [F.when(F.col("a") < F.col("b"), x).otherwise(y) for x, y in zip(*ends)]
    high = [F.when(F.col("a") < F.col("b"), y).otherwise(x) for x, y in zip(*ends)]
    names = ("a", "a_n", "b", "b_n")
    found = lookups.join(entries, [*meet, first & letters & alike]).select(*[c.alias(n) for c, n in zip((*low, *high), names)]).distinct()
    # A pair goes out both ways from its one row, so the join runs once.
    both = F.array(F.struct("a", "a_n", "b", "b_n"), F.struct(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    return found.select(F.inline(both))


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each distinct word (word, n).

    ``form`` is the most frequent near word (first by text among equals) if it occurs at least
    ``times`` as often; ``root`` is reached by following forms. Each step multiplies the
    count by ``times``, so a path's length is bounded by the logarithm of the greatest count, and each
    round doubles how far a word has come.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its variants")
    words = common.written(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    best = F.min(F.struct((-F.col("b_n")).alias("order"), F.col("b").alias("form")))
    near = pairs.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n")
    )
    enough = F.col("form_n") >= times * F.col("n")
    table = known.withColumns({c: F.when(enough, F.col(c)) for c in ("form", "form_n")})
    table = common.written(table.withColumn("root", F.coalesce("form", "word")), "forms")
    counts = words.agg(F.max("n"), F.min("n")).first()
    steps = math.floor(math.log(counts[0] / counts[1], times) + 1e-9) if counts[0] else 0
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        # Words that are already at their root need no look; the others ask where their present end goes on to.
        ends = table.filter("form is not null").select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = table.join(ends, "root", "left").withColumn("root", F.coalesce("next", "root")).drop("next")
        table = common.written(moved, "forms")
    return table.select("word", "n", "n_near", "form", "form_n", "root")
