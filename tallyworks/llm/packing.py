"""Packing of tokenised documents into sequences of a fixed capacity.

Documents are tokenised once and cut at every full capacity; full pieces and remainders go to a table
in the shared folder, each with its size class (its length in units of ``WIDTH`` tokens, rounded up), the
task that wrote it, and its rank among that task's pieces of the class. The histogram of the classes, at most
256 numbers, is all that the driver sees: cutting stock turns it into patterns. A piece's rank
in its class over all tasks, the rank above plus the counts of the tasks before, picks
its pattern, and so its sequence. The ranks need no sort and no window over a class, and the ids are never shuffled: only
narrow rows go by sequence, to add up the offsets.

Documents stay whole unless they are longer than a sequence. What is padded is the rounding to
``WIDTH`` and the few bins at the end.

Nulls and odd cases: a null or empty text is the closing id alone; rows that repeat a doc_id
are documents of their own, and so are rows without one; an empty table packs nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyworks.llm import common, cutting_stock
from tallyworks.llm.tokens import Vocabulary
from tallyworks.sources import scratch

CAPACITY = 2048
CLOSING = 1
WIDTH = 8
# So many pieces go into one batch of rows.
BATCH = 2000


def pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """A written table of pieces (doc_id, start, length, ids, doc_tokens, part, size, rank).

    ``ids`` holds little-endian unsigned 32-bit numbers. ``part``, ``size`` and ``rank`` name a piece.
    """
    common.ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)])
    for name, kind in zip(("start", "length", "ids", "doc_tokens", "part", "size", "rank"), ("long", "long", "binary", "long", "int", "int", "long")):
        schema.add(name, {"long": T.LongType(), "int": T.IntegerType(), "binary": T.BinaryType()}[kind])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks, rows = TaskContext.get().partitionId(), np.zeros(capacity // WIDTH + 1, int), []
        for batch in batches:
            doc_ids = batch.column(0)
            arrow = pa.schema([("doc_id", doc_ids.type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("part", pa.int32()), ("size", pa.int32()), ("rank", pa.int64())])
            for doc_id, ids in zip(doc_ids.to_pylist(), vocabulary.encode(x.as_py() for x in batch.column(1))):
                ids = np.array([*ids, closing], "<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    size = -(-len(piece) // WIDTH)
                    rows.append((doc_id, start, len(piece), piece.tobytes(), len(ids), part, size, int(ranks[size])))
                    ranks[size] += 1
                if len(rows) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                rows = []

    path = scratch.new_folder(docs.sparkSession, "pieces")
    cut_rows = docs.select("doc_id", "text").mapInArrow(cut, schema)
    cut_rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def assign(cut: DataFrame, capacity: int = CAPACITY, *extra: str) -> DataFrame:
    """Each piece's sequence_id and offset, beside its name, length and the ``extra`` columns.

    ``cut`` is the written table of pieces; its ids are read only if named in ``extra``.
    """
    spark = cut.sparkSession
    counts = common.written(cut.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # At most capacity / WIDTH rows.
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots, taken, first = [], dict.fromkeys(histogram, 0), 0
    for pattern, times in cutting_stock.solve(histogram, capacity // WIDTH):
        for size, copies in pattern.items():
            slots.append((size, taken[size], taken[size] + times * copies, copies, first))
            taken[size] += times * copies
        first += times
    # A few sizes in each of at most some hundred patterns, whatever the input.
    table = F.broadcast(spark.createDataFrame(slots, "size int, low long, high long, copies long, first long"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = cut.select("part", "size", "rank", "length", *extra).join(offsets, ["size", "part"])
    rows = rows.withColumn("place", F.col("base") + F.col("rank"))
    rows = rows.join(table, "size").filter("place >= low and place < high")
    rows = rows.withColumn("sequence_id", F.col("first") + F.expr("(place - low) div copies"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0))
    return rows.select("part", "size", "rank", "length", *extra, "sequence_id", offset.alias("offset"))


def pack(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """Packed pieces with their ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    packed = assign(pieces(docs, vocabulary, capacity), capacity, "doc_id", "start", "ids", "doc_tokens")
    return packed.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def digests(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """As :func:`pack`, with the CRC-32 of the ids in their place: the ids stay where they were written."""
    cut = pieces(docs, vocabulary, capacity).withColumn("ids_crc32", F.crc32("ids"))
    packed = assign(cut, capacity, "doc_id", "start", "ids_crc32", "doc_tokens")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
