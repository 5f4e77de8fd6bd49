"""Near copies by exact Jaccard similarity of word shingles.

Texts are sets of hashed shingles of five words. Near copies are first looked for by SimHash fingerprints of
these shingles, in the index of byte positions with its count filter (``simhash``): each text is compared with the first of
its component. At a similarity of 0.8, about 15 % of the bits of a fingerprint differ whatever its width, more than one in
each byte, so no number of equal bytes is guaranteed. Among the texts that then stay, further pairs therefore come from bands of minimum
hashes: a pair of similarity 0.8 misses all 32 bands of 6 with a probability of 6e-5. Each candidate pair of either kind is
joined back to the shingle hashes, and only an exact similarity of ``SIMILAR`` or more counts.

A text stays unless a text before it, by doc_id, stays and is similar: the greedy independent set of the
similarity graph. So every text that goes has a verified similarity to one that stays. Equal sets are joined
to one first. After the fingerprints each text is compared with one other alone, the first of all that share a list with it, so a
large group of near copies gives a row per member and most of them go; those that are left are compared with the first of
each of their lists. Among the texts that then stay, candidates are exact: with the shingles of every text in one order, rare ones
first, two similar texts have one in common among the first fifth of each, at a place from which enough are left to
come. Pairs without one never become rows, such as those of a large group whose members are all a little too far apart.
This is repeated until no two that stay are similar.

Texts and sets are told apart by 128-bit digests. Nulls and odd cases: null and empty texts are one empty set; a text of
fewer words than a shingle is one shingle; very long texts are sets like any other; rows are told apart by doc_id
and text, of equal ones one stays; rows without a doc_id stay, and nothing goes for them; an empty table gives an empty
one; columns of any names are handed on as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common, simhash
from tallyworks.llm.simhash import LOWER, SEED

WORDS = 5
# Similar from 4 shared shingles of 5.
SIMILAR = (4, 5)
BANDS, ROWS = 32, 6
# Classes by which shingles are counted.
CLASSES = 1 << 16
# So many hashes at a time stay within a core's cache.
BLOCK = 512

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(data: bytes | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of a UTF-8 text's shingles, sorted."""
    found = (data or b"").translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    width = min(words, len(found))
    starts = np.concatenate(([0], ends[: len(found) - width] + 1)).tolist()
    hash64 = xxhash.xxh64_intdigest
    return np.unique(np.array([hash64(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist())], np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The hash of each band of minimum hashes, as signed numbers; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    mixed = hashes ^ (hashes >> np.uint64(31))
    for at in range(0, len(mixed), BLOCK):
        np.minimum(least, (mixed[at : at + BLOCK] * FACTORS + SHIFTS).min(1), out=least)
    keys = [xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column(2).to_pylist()]
        ids = [xxhash.xxh3_128_digest(s.tobytes(), SEED) for s in sets]
        keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
        prints = pa.array([simhash.majority(s) for s in sets], pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), prints, keys]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "set_id", "n", "fingerprint", "bands"])


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose exact similarity reaches ``SIMILAR``; sizes that rule it out go first."""
    least, whole = SIMILAR
    pairs = pairs.filter(whole * F.least("a_n", "b_n") >= least * F.greatest("a_n", "b_n")).select("a", "b").distinct()
    left = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("a_hashes"))
    right = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("b_hashes"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("a_hashes", "b_hashes"))
    union = F.size("a_hashes") + F.size("b_hashes") - shared
    return common.written(both.filter(whole * shared >= least * union).select("a", "b"), "similar")


def _removed(edges: DataFrame) -> DataFrame:
    """(set_id): what the greedy independent set leaves out. ``edges``: (a, b) where a comes before b."""
    removed = common.written(edges.select(F.col("b").alias("set_id")).limit(0), "removed")
    left = edges
    while not left.isEmpty():
        # Sets that come after no set still open stay; what is similar to them goes.
        stay = left.select("a").distinct().join(left.select(F.col("b").alias("a")), "a", "left_anti")
        gone = common.written(left.join(stay, "a").select(F.col("b").alias("set_id")).distinct(), "removed")
        removed = removed.unionByName(gone)
        ends = gone.withColumnRenamed("set_id", "a")
        left = left.join(ends, "a", "left_anti").join(ends.withColumnRenamed("a", "b"), "b", "left_anti")
        left = common.written(left.select("a", "b"), "open")
    return removed


def class_counts(sets: DataFrame) -> np.ndarray:
    """The shingles of all sets counted by hash class: a table of a fixed size, whatever the texts."""
    kind = F.pmod("h", F.lit(CLASSES)).alias("kind")
    counts = np.zeros(CLASSES, np.int64)
    for row in sets.select(F.explode("hashes").alias("h")).groupBy(kind).count().collect():
        counts[row["kind"]] = row["count"]
    return counts


def prefix(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashes of which two similar sets have one in common: rare ones first, as many as similarity may miss, and one."""
    least, whole = SIMILAR
    ranked = hashes[np.lexsort((hashes, counts[np.mod(hashes, CLASSES)]))]
    return ranked[: len(hashes) - -(-least * len(hashes) // whole) + 1]


def _candidates(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of sets that can be similar by their prefixes, and few others; a comes before b.

    Two sets that first agree at these places of the order have no more in common than what follows there.
    """
    least, whole = SIMILAR

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [prefix(np.array(h, np.int64), counts) for h in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lists, pa.list_(pa.int64()))], ["set_id", "doc_id", "n", "prefix"])

    schema = "set_id binary, doc_id long, n int, prefix array<long>"
    entries = sets.select("set_id", "doc_id", "n", "hashes").mapInArrow(prefixes, schema)
    entries = entries.select("set_id", "doc_id", "n", F.posexplode("prefix").alias("place", "shingle"))
    a, b = [entries.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in ("set_id", "doc_id", "n", "place")]) for side in "ab"]
    before = F.struct("a_doc_id", "a_set_id") < F.struct("b_doc_id", "b_set_id")
    sizes = whole * F.least("a_n", "b_n") >= least * F.greatest("a_n", "b_n")
    rest = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    enough = (least + whole) * rest >= least * (F.col("a_n") + F.col("b_n"))
    pairs = a.join(b, [a["shingle"] == b["shingle"], before & sizes & enough])
    return pairs.select(F.col("a_set_id").alias("a"), "a_n", F.col("b_set_id").alias("b"), "b_n")


def _fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """(b, b_n, lead): each set whose fingerprint is linked with others, with the first of the component.

    ``classes`` is a written table of sets with doc_id and fingerprint.
    """
    member = F.struct("doc_id", "set_id", "n")
    first = classes.groupBy("fingerprint").agg(F.min(member).alias("lead"), F.count(F.lit(1)).alias("size"))
    prints = common.written(first, "prints")
    rooted = common.written(simhash.rooted(prints), "rooted")
    groups = rooted.groupBy("root").agg(F.min("lead").alias("lead"), F.sum("size").alias("size")).filter("size > 1")
    leads = rooted.select("fingerprint", "root").join(groups.drop("size"), "root")
    others = classes.join(leads, "fingerprint").filter("set_id != lead.set_id")
    return others.select(F.col("set_id").alias("b"), F.col("n").alias("b_n"), "lead")


def _first_of_lists(entries: DataFrame) -> DataFrame:
    """(b, b_n, lead): each member of a list that is not its first, with the first."""
    member = F.struct("doc_id", "set_id", "n")
    firsts = entries.groupBy("band", "key").agg(F.min(member).alias("lead"))
    others = entries.join(firsts, ["band", "key"]).filter("set_id != lead.set_id")
    return others.select(F.col("set_id").alias("b"), F.col("n").alias("b_n"), "lead")


def _with_lead(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("lead.set_id").alias("a"), F.col("lead.n").alias("a_n"), "b", "b_n")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents without those that are similar to one before them that stays."""
    common.ship(docs.sparkSession)
    # Whatever columns the documents have, the digest of the text has a name of its own.
    digest = common.free_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    own = F.col(digest).alias("text_hash")
    rows = keyed.filter("doc_id is not null").select("doc_id", own, F.col("text").cast("binary").alias("text"))
    rows = rows.mapInArrow(_sketch, "doc_id long, text_hash binary, set_id binary, n int, fingerprint long, bands array<long>")
    rows = common.written(rows, "sketches")
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    same = [F.first(c).alias(c) for c in ("n", "fingerprint", "bands")]
    classes = common.written(rows.groupBy("set_id").agg(first, *same), "sets")
    linked = _fingerprint_pairs(classes.select("set_id", "first.doc_id", "n", "fingerprint"))
    linked = common.written(linked.select("b", "b_n", "lead"), "linked")
    entries = classes.select("set_id", "first.doc_id", "n", F.posexplode("bands").alias("band", "key"))
    lists = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    entries = common.written(entries.join(lists, ["band", "key"]).drop("size"), "lists")

    @F.pandas_udf("array<long>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).view(np.int64) for t in texts])

    # Only texts that share a list or are linked by fingerprints are hashed again.
    met = entries.select("set_id").unionByName(linked.select(F.explode(F.array("b", "lead.set_id")).alias("set_id"))).distinct()
    shared = classes.select("set_id", "n", "first.*").join(met, "set_id", "left_semi")
    texts = keyed.select("doc_id", own, "text")
    sets = texts.join(shared, ["doc_id", "text_hash"]).dropDuplicates(["set_id"])
    sets = common.written(sets.select("set_id", "doc_id", "n", hashed(F.col("text").cast("binary")).alias("hashes")), "shingles")

    edges = _similar(_with_lead(linked), sets)
    removed = common.written(_removed(edges), "removed")
    left = entries.join(removed, "set_id", "left_anti")
    nearest = _first_of_lists(left).groupBy("b").agg(F.min("lead").alias("lead"), F.first("b_n").alias("b_n"))
    edges = edges.unionByName(_similar(_with_lead(nearest), sets))
    removed = common.written(_removed(edges), "removed")
    left = entries.join(removed, "set_id", "left_anti")
    edges = edges.unionByName(_similar(_with_lead(_first_of_lists(left)), sets))
    counts = class_counts(sets)
    while True:
        removed = common.written(_removed(edges), "removed")
        stay = sets.join(removed, "set_id", "left_anti")
        found = _similar(_candidates(stay, counts), sets)
        if found.isEmpty():
            break
        edges = edges.unionByName(found)

    kept = classes.join(removed, "set_id", "left_anti").select("first.doc_id", F.col("first.text_hash").alias(digest))
    firsts = common.written(kept, "kept")
    # What repeats both doc_id and text is thinned to one row; only those rows are moved.
    key = ["doc_id", digest]
    repeated = rows.groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", F.col("text_hash").alias(digest))
    chosen = keyed.join(firsts, key, "left_semi")
    once = chosen.join(repeated, key, "left_anti")
    twice = chosen.join(repeated, key, "left_semi").dropDuplicates(key)
    return once.unionByName(twice).unionByName(keyed.filter("doc_id is null")).select(docs.columns)
