"""Benchmark decontamination with spaced seeds.

A mask picks some of the words in a window and ignores the others, so a window that had words exchanged at the
ignored places still has the same hash. Every window of the test items and of the documents is
hashed under each mask; equal hashes place an item on a document. Around each hit the
item is laid along the document, word by word, and counts as found if some stretch of
``STRETCH`` words (or the whole item, if it is shorter) agrees in at least ``SHARE`` of them.

Words are lower-cased, and ASCII punctuation counts as space. Hits carry the hashed words of the stretch they
claim, so that no text is read or moved again.

Items shorter than a stretch are hashed whole, under masks of their own length that leave one untouched by every
exchange that ``SHARE`` allows; documents are hashed for such a length only if some item has it.

Nulls and odd cases: a null or empty text has no words and gives no hit; documents that share a doc_id, or items that share an item_id, count
as one; a null id is kept as null. Empty tables give no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

# Within any 13 words, two exchanged ones leave a window of one of these masks untouched (see the tests).
MASKS = ("11101011", "11001111")
STRETCH = 13
SHARE = 0.8
# So many words of an item tell that a document holds it.
EVIDENCE = 5
# Hashes of test items are broadcast up to so many rows (24 bytes each); beyond, places are joined by shuffle.
BROADCAST_ROWS = 1_000_000
# What parts words: white space and ASCII punctuation.
BETWEEN = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def masks_for(length: int) -> tuple[str, ...]:
    """The masks for items of so many words, of which each allowed pattern of exchanged words leaves one untouched."""
    if length >= STRETCH:
        return MASKS
    allowed = length - math.ceil(SHARE * length)
    # Of allowed + 2 blocks of words, each mask ignores as many as words may be exchanged.
    blocks = allowed + 2
    block = [i * blocks // length for i in range(length)]
    return tuple("".join("0" if b in ignored else "1" for b in block) for ignored in combinations(range(blocks), allowed))


def _hashed(rows: DataFrame, key: str) -> DataFrame:
    """(key, h): the hashes of the words of each text, of which there may be none."""
    parts = F.split(F.lower(F.coalesce("text", F.lit(""))), BETWEEN)
    hashes = F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))
    return rows.select(F.col(key).alias("key"), hashes.alias("h"))


def _seeds(rows: DataFrame, masks: tuple[str, ...], *carried: str) -> DataFrame:
    """One row for each window and mask: its hash and its place, beside the carried columns.

    The windows are exploded as numbers and hashed in rows of their own, which Spark compiles; a lambda over them it would
    interpret. The frame is not filtered by its number of words, as the planner would then split the texts once
    for the filter and again for the rows: a text that is too short leaves one row without a number.
    """
    span, count = len(masks[0]), len(masks)
    windows = (F.size("h") - (span - 1)) * count
    numbers = F.when(windows > 0, F.sequence(F.lit(0), windows - 1))
    found = rows.select("*", F.explode_outer(numbers).alias("n")).filter("n is not null")
    place, mask = F.expr(f"n div {count}").cast("int"), F.col("n") % count

    def hashed(number: int) -> Column:
        return F.xxhash64(F.lit(number), *[F.get("h", place + j) for j, bit in enumerate(masks[number]) if bit == "1"])

    seed = hashed(count - 1)
    for number in range(count - 1):
        seed = F.when(mask == number, hashed(number)).otherwise(seed)
    return found.select(*carried, seed.alias("seed"), place.alias("place"))


def _hits(words: DataFrame, seeds: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(key, h, place, item_id, item_size, item_place): windows of documents with the hash of a window of an item.

    Beside broadcast seeds the words of a text ride along, as the rows never leave their task. Where the
    join shuffles, that would move each text once for each of its windows: there only places are
    joined, and the words are fetched for the texts that were hit.
    """
    if seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return _seeds(words, masks, "key", "h").join(F.broadcast(seeds), "seed")
    words = words.withColumn("text_hash", F.xxhash64("h"))
    places = _seeds(words, masks, "key", "text_hash").join(seeds, "seed").distinct()
    places = places.select(F.col("key").alias("hit_key"), F.col("text_hash").alias("hit_hash"), "place", "item_id", "item_size", "item_place")
    same = (F.col("text_hash") == F.col("hit_hash")) & F.col("key").eqNullSafe(F.col("hit_key"))
    return places.join(words, same).drop("hit_key", "hit_hash", "text_hash")


def overlaps(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, agreeing, compared): verified overlaps, one for each pair and alignment.

    ``doc_word`` and ``item_word`` are the first words laid side by side, ``compared`` of which
    ``agreeing`` are the same.
    """
    items = _hashed(tests, "item_id").withColumnRenamed("key", "item_id").filter(F.size("h") > 0)
    items = common.written(items.distinct(), "items")
    sized = items.withColumn("item_size", F.size("h"))
    hits = None
    # At most as many rows as a stretch has words.
    lengths = {r["length"] for r in sized.select(F.least(F.lit(STRETCH), "item_size").alias("length")).distinct().collect()}
    for length in sorted(lengths | {STRETCH}):
        masks = masks_for(length)
        some = sized.filter(F.least(F.lit(STRETCH), "item_size") == length)
        seeds = common.written(_seeds(some, masks, "item_id", "item_size").withColumnRenamed("place", "item_place").distinct(), "seeds")
        found = _hits(_hashed(docs, "doc_id"), seeds, masks)
        hits = hits.unionByName(found) if hits else found
    start = F.col("place") - F.col("item_place")
    first, skipped = F.greatest(start, F.lit(0)), F.greatest(-start, F.lit(0))
    length = F.least(F.size("h") - first, F.col("item_size") - skipped)
    claimed = hits.select(
        F.col("key").alias("doc_id"),
        "item_id",
        first.alias("doc_word"),
        skipped.alias("item_word"),
        F.slice("h", first + 1, length).alias("side"),
    ).distinct()
    laid = claimed.join(items, claimed["item_id"].eqNullSafe(items["item_id"])).drop(items["item_id"])
    other = F.slice("h", F.col("item_word") + 1, F.size("side"))
    same = F.zip_with("side", other, lambda a, b: F.when(a == b, 1).otherwise(0))
    laid = laid.select(
        "doc_id", "item_id", "doc_word", "item_word", F.least(F.lit(STRETCH), F.size("h")).alias("stretch"), same.alias("same")
    )
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b)
    starts = F.sequence(F.lit(0), F.size("same") - F.col("stretch"))
    best = F.array_max(F.transform(starts, lambda i: total(F.slice("same", i + 1, F.col("stretch")))))
    best = F.when(F.size("same") >= F.col("stretch"), best).otherwise(0)
    laid = laid.select("*", best.alias("best")).filter(F.col("best") >= F.ceil(SHARE * F.col("stretch")))
    return laid.select(
        "doc_id", "item_id", "doc_word", "item_word", total("same").alias("agreeing"), F.size("same").alias("compared")
    )


def decontaminate(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The documents without those that overlap with a test item in ``EVIDENCE`` words or more. Rows without a doc_id stay.

    Items of fewer words are common words or phrases: ``overlaps`` reports where they stand, but no document goes for them.
    """
    found = overlaps(docs, tests).filter(F.col("compared") >= EVIDENCE)
    found = common.written(found.select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
