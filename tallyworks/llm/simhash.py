"""SimHash near-duplicates, found through an inverted index of byte positions.

A document's fingerprint has 64 bits: each is the majority of that bit over the hashes of its
word shingles. Two fingerprints are linked if at most 3 bits differ. Then at most 3 of their 8
bytes differ, so a linked pair shares at least 5 positional bytes. A posting list of a single
positional byte would hold a 256th of all fingerprints, and pairs from it would grow with the
square of the corpus. So the lists are keyed by four positional bytes at once: of the 14 quadruples
of positions whose numbers have XOR zero, one is free of any three given positions, hence every
pair with 5 equal bytes meets in some list. In each list the shared positional bytes
of a pair are tallied, pairs below 5 are dropped, and the rest are verified bit by bit.

Lists that hold very many fingerprints (near copies of one text) are cut up before any pair is
looked at: the bits that the list leaves open are divided into four blocks, of which a linked
pair has one in common, so the members go to four narrower lists. After three such steps a list
can hold at most 2 ** 14 distinct fingerprints. From each list only a spanning forest of its
links leaves the task, so dense groups give few rows and lose no connection.

Nulls and odd cases: a null or empty text has fingerprint zero and is linked like any other; a
text of fewer words than a shingle is one shingle; rows that repeat a doc_id each get a row;
a null doc_id never becomes a component's id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common, components

SEED = 42
MAX_BITS = 3
SHARED_BYTES = 5
BLOCK = 1 << 16
LIST_MAX = 4096
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

LINK_SCHEMA = "a long, b long"


def fingerprint(data: bytes | None, words: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed number."""
    found = (data or b"").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    width = min(words, len(found))
    starts = np.concatenate(([0], ends[: len(found) - width] + 1)).tolist()
    stops = ends[width - 1 :].tolist()
    hash64, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK], stops[at : at + BLOCK])
        total += _bits(np.array([hash64(joined[s:e], SEED) for s, e in spans], "<u8"))
    return _majority(total, len(starts))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(total: np.ndarray, n: int) -> int:
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set of unsigned shingle hashes, as a signed number; zero for none."""
    blocks = (hashes[at : at + BLOCK] for at in range(0, len(hashes), BLOCK))
    return _majority(sum((_bits(np.ascontiguousarray(b, "<u8")) for b in blocks), np.zeros(64, np.int64)), len(hashes))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint) for each row."""
    common.ship(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return docs.select("doc_id", simhash(F.col("text").cast("binary")).alias("fingerprint"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masks() -> list[int]:
    """Masks of the 14 quadruples of byte positions that every pair with 5 equal bytes needs."""
    quads = (q for q in combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0)
    return [sum(0xFF << (8 * p) for p in q) for q in quads]


def _narrower(mask: int) -> list[int]:
    """The four masks that fix, besides this mask's bits, one of four blocks of the others."""
    free = [b for b in range(64) if not mask >> b & 1]
    blocks = np.array_split(np.array(free), MAX_BITS + 1)
    return [mask | sum(1 << int(b) for b in block) for block in blocks]


def near(x: np.ndarray) -> np.ndarray:
    """Whether pairs with these XORs are linked: tally of equal positional bytes, then all bits."""
    shared = (np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1)
    hit = shared >= SHARED_BYTES
    hit[hit] = np.bitwise_count(x[hit]) <= MAX_BITS
    return hit


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among one list's distinct members."""
    links, left = [], members
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            hit = near(left ^ one)
            links.extend((int(one), int(other)) for other in left[hit])
            reached.extend(left[hit])
            left = left[~hit]
    return links


def _links(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within lists; rows lie list by list, ``keys`` numbers the lists."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [], []
    for at in np.flatnonzero(sizes > 64):
        for one, other in _forest(members[starts[at] : starts[at] + sizes[at]]):
            a.append(one)
            b.append(other)
    small = np.repeat(sizes <= 64, sizes)
    found = [(np.array(a, np.uint64), np.array(b, np.uint64))]
    k, m = keys[small], members[small]
    for step in range(1, int(min(64, sizes.max(initial=1)))):
        i = np.flatnonzero(k[step:] == k[:-step])
        i = i[near(m[i] ^ m[i + step])]
        found.append((m[i], m[i + step]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of whole lists; rows come sorted by list, and a list may span batches."""
    rest = np.empty((0, 3), np.int64)

    def links(rows: np.ndarray) -> pa.RecordBatch:
        new = np.r_[False, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        a, b = _links(np.cumsum(new), np.ascontiguousarray(rows[:, 2]).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        rows = np.concatenate([rest, rows])
        if not len(rows):
            continue
        last = np.flatnonzero((rows[:, :2] == rows[-1, :2]).all(1))[0]
        rest = rows[last:]
        if last:
            yield links(rows[:last])
    if len(rest):
        yield links(rest)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly those within 3 bits.

    ``prints`` is a written table whose column ``fingerprint`` holds distinct values. Of each
    list only a spanning forest is returned, so not every linked pair appears, but every
    component does.
    """
    spark, masks, found = prints.sparkSession, _masks(), []
    entries = prints.select(F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fingerprint")
    value = F.col("mask").bitwiseAND(F.col("fingerprint")).alias("value")
    entries = entries.select("mask", value, "fingerprint")
    for level in range(4):
        sizes = entries.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sizes = common.written(sizes, "lists")
        most = LIST_MAX if level < 3 else 1 << 14
        lists = entries.join(sizes.filter(F.col("n") <= most).drop("n"), ["mask", "value"])
        lists = lists.repartition("mask", "value").sortWithinPartitions("mask", "value")
        found.append(lists.select("mask", "value", "fingerprint").mapInArrow(_verify, LINK_SCHEMA))
        crowded = sizes.filter(F.col("n") > most).drop("n")
        if crowded.isEmpty():
            break
        pairs = [(_signed(m), _signed(n)) for m in masks for n in _narrower(m)]
        masks = sorted({n for m in masks for n in _narrower(m)})
        # At most 14 * 4 ** 3 rows, whatever the input.
        narrower = F.broadcast(spark.createDataFrame(pairs, "mask long, next long"))
        entries = entries.join(crowded, ["mask", "value"]).join(narrower, "mask")
        value = F.col("next").bitwiseAND(F.col("fingerprint")).alias("value")
        entries = entries.select(F.col("next").alias("mask"), value, "fingerprint").distinct()
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def rooted(prints: DataFrame) -> DataFrame:
    """``prints`` with ``root``, one fingerprint of the component that each belongs to."""
    stars = components.roots(links(prints)).withColumnRenamed("node", "fingerprint")
    return prints.join(stars, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id that links can reach."""
    rows = common.written(fingerprints(docs, words), "fingerprints")
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    prints = common.written(prints, "prints")
    members = rooted(prints)
    firsts = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = members.join(firsts, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicate(docs: DataFrame, words: int = 3) -> DataFrame:
    """One document of each component: the one with the smallest doc_id.

    Rows that repeat a doc_id count as one document and leave one row. Rows without a doc_id stay.
    """
    groups = common.written(near_duplicates(docs, words), "groups")
    removed = groups.filter("doc_id != component_id").select("doc_id")
    repeated = groups.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    once = docs.join(removed.unionByName(repeated).distinct(), "doc_id", "left_anti")
    twice = docs.join(repeated.join(removed, "doc_id", "left_anti"), "doc_id", "left_semi")
    return once.unionByName(twice.dropDuplicates(["doc_id"])).select(docs.columns)
