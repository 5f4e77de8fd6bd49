"""Tokens as binary shards in training order.

Documents are tokenised once; each task joins its documents, with a closing id after each, and cuts them into
sequences of ``LENGTH`` ids (the last is filled up with the closing id). A sequence's number is its place among those of its
task plus the counts of the tasks before. A keyed Feistel network over the smallest even number of bits that holds all
numbers, walked until it falls below their count, turns the number into a global slot. The sequences are dealt out by
ranges of slots, and each range is written in order as a shard in which every record has the same length in bytes: the
ids as little-endian 16-bit numbers and a line feed. So a reader that stopped at a slot knows the shard and the
byte to go on from, without any index.

The sequences are stored and move through the shuffle compressed, with a dictionary of tokens from a few documents;
it bears on nothing but their size. Spark writes and reads the shards through its own
sources, to and from any storage that it knows.

Nulls and odd cases: a null or empty text is the closing id alone; ids of documents play no part, so repeated rows
count each; an empty table gives no shard. Vocabularies of more than 65,536 ids are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.llm import common
from tallyworks.llm.tokens import Vocabulary

LENGTH = 2048
CLOSING = 50256
PER_SHARD = 4096
ROUNDS = 6
# The dictionary holds at most so many ids, from at most so many documents; it is sent to every task.
DICTIONARY_IDS = 56_000
DICTIONARY_DOCUMENTS = 64
LEVEL = 6
KEY = 0x5EED


def feistel(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """A permutation of the numbers below ``count``, for an array of them."""
    half = max(1, ((max(count - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(ROUNDS):
            mixed = right + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(31))) & mask)
        return left << np.uint64(half) | right

    found = once(numbers.astype(np.uint64))
    while (outside := found >= np.uint64(count)).any():
        found[outside] = once(found[outside])
    return found.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know of a folder of shards."""

    folder: str
    sequences: int
    length: int = LENGTH
    per_shard: int = PER_SHARD

    @property
    def stride(self) -> int:
        return 2 * self.length + 1


def dictionary(docs: DataFrame, vocabulary: Vocabulary) -> bytes:
    """Some tokens of the corpus, for the compressor to refer to."""
    common.ship(docs.sparkSession)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[int] = []
        for batch in batches:
            for ids in vocabulary.encode(x.as_py() for x in batch.column(0)):
                kept = (kept + ids)[:DICTIONARY_IDS]
        yield pa.RecordBatch.from_arrays([pa.array([np.array(kept, "<u4").astype("<u2").tobytes()], pa.binary())], ["tokens"])

    rows = docs.select("text").limit(DICTIONARY_DOCUMENTS).coalesce(1).mapInArrow(tokens, "tokens binary")
    found = rows.first()
    return bytes(found["tokens"]) if found else b""


def _dictionary(content: bytes) -> dict:
    if not content:
        return {}
    return {"dict_data": zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)}


def sequences(docs: DataFrame, vocabulary: Vocabulary, shared: bytes, length: int = LENGTH, closing: int = CLOSING) -> DataFrame:
    """A written table (part, number, used, ids): ``ids`` compressed, ``used`` of them not filling."""
    common.ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rest = TaskContext.get().partitionId(), 0, np.empty(0, "<u2")
        packer = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(shared))

        def rows(ids: np.ndarray, used: list[int]) -> pa.RecordBatch:
            packed = [packer.compress(x.tobytes()) for x in ids.reshape(-1, length)]
            numbers = np.arange(number, number + len(packed))
            columns = [pa.array([part] * len(packed), pa.int32()), pa.array(numbers), pa.array(used, pa.int32()), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "number", "used", "ids"])

        for batch in batches:
            found = [rest]
            for ids in vocabulary.encode(x.as_py() for x in batch.column(0)):
                if ids and max(ids) > 0xFFFF:
                    raise ValueError("the vocabulary does not fit 16-bit ids")
                found.append(np.array([*ids, closing], "<u2"))
            rest = np.concatenate(found)
            whole = len(rest) // length
            if whole:
                yield rows(rest[: whole * length], [length] * whole)
                number, rest = number + whole, rest[whole * length :]
        if len(rest):
            yield rows(np.concatenate([rest, np.full(length - len(rest), closing, "<u2")]), [len(rest)])

    return common.written(docs.select("text").mapInArrow(cut, "part int, number long, used int, ids binary"), "sequences")


def write(docs: DataFrame, vocabulary: Vocabulary, folder: str, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> Layout:
    """Write the shards of all documents below ``folder`` and return their layout."""
    shared = dictionary(docs, vocabulary)
    rows = sequences(docs, vocabulary, shared, length)
    counts = common.written(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # One row per task that wrote sequences.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = rows.join(bases, "part").select((F.col("base") + F.col("number")).alias("number"), "ids")

    @F.pandas_udf("long")
    def slot(numbers):
        import pandas as pd

        return pd.Series(feistel(numbers.to_numpy(), total, key))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(**_dictionary(shared))
        for batch in batches:
            raw = pa.array([opener.decompress(x.as_py()) for x in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw], ["shard", "slot", "ids"])

    placed = rows.select(slot("number").alias("slot"), "ids")
    placed = placed.select(F.expr(f"slot div {per_shard}").alias("shard"), "slot", "ids")
    shards = max(1, -(-total // per_shard))
    dealt = placed.repartitionByRange(shards, "shard").mapInArrow(opened, "shard long, slot long, ids binary")
    # The bytes pass as they are: casting to text changes none of them.
    lines = dealt.sortWithinPartitions("shard", "slot").select("shard", F.col("ids").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(folder)
    return Layout(folder, total, length, per_shard)


def read(spark: SparkSession, layout: Layout, start: int = 0) -> DataFrame:
    """(shard, slot, ids) from a slot on: earlier shards are not opened. ``ids`` holds 16-bit numbers.

    A shard is at most ``per_shard`` records, which bounds what one row holds.
    """
    schema = "path string, modificationTime timestamp, length long, content binary, shard long"
    if not layout.sequences:
        return spark.createDataFrame([], "shard long, slot long, ids binary")
    files = spark.read.format("binaryFile").schema(schema).load(layout.folder)
    files = files.filter(F.col("shard") >= start // layout.per_shard)
    records = F.sequence(F.lit(0), F.expr(f"length div {layout.stride} - 1"))
    rows = files.select("shard", "content", F.explode(records).alias("record"))
    slot = F.col("shard") * layout.per_shard + F.col("record")
    ids = F.substring("content", (F.col("record") * layout.stride + 1).cast("int"), F.lit(2 * layout.length))
    return rows.select("shard", slot.alias("slot"), ids.alias("ids")).filter(F.col("slot") >= start)
