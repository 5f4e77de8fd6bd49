"""Hard negatives by exact inner products, with coordinate pruning over length buckets.

Vectors are sorted by length and cut into buckets. A bucket keeps, for every coordinate of its unit
vectors, the order of its members by that coordinate. An anchor that needs a score of at least some
bound can reach it in a bucket only at an angle of at most the one whose cosine is bound / (its length x the
bucket's greatest length). By that angle, each of the anchor's largest coordinates (its focus) leaves a range of
values for the same coordinate of the other vector: two binary searches in the sorted list. Members
within all ranges are candidates, and only their scores are computed, exactly. Whole buckets whose greatest
length cannot reach the bound are never joined with the anchors.

The bounds come from an exact search of a small sample of the rows (``SAMPLE``): the k-th best score among some of the
rows is never above that of all. The sample gives bounds only; every row is searched.

Anchors go in blocks against the buckets: both are of bounded size, whatever the table, and a block or bucket is
found by hash or by rank, so that equal vectors or labels put no load on one task. Components that fit two bytes take no
more on the way. A task holds a bounded number of buckets and reads the blocks one after the other; neither goes through
the driver. Of each block at most k rows an anchor (and positive) leave the task.

Odd cases: rows with a null label, null vector or any null or non-finite component take no part. A null
vec_id is never an anchor, and comes last among equal scores. Equal vec_ids are rows of their own: all
but the anchor's own row are others. Ties go by the smaller vec_id. Shorter vectors count as filled up with zeros. An empty table
gives an empty result; columns of other names are ignored. Scores that do not fit a long raise.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm import common

# Numbers in a bucket (rows times coordinates); anchors in a block; rows of the sample; focus coordinates.
BUCKET_CELLS = 1 << 18
BLOCK = 256
SAMPLE = 4096
FOCUS = 5
# Buckets that a task holds, on average at most; tasks among which fewer are dealt out; blocks that meet the sample in one task.
HELD = 32
PARTS = 64
SAMPLE_BLOCKS = 16
# Stands for a null vec_id while rows are ordered.
NO_ID = (1 << 63) - 1
# Sums of products below this are exact in double precision.
EXACT = float(1 << 53)

BUCKET_SCHEMA = "bucket long, shortest double, longest double, width int, rows binary, ids binary, labels binary, vectors binary, orders binary"
FOUND_SCHEMA = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, other long, other_id long, score long"
WANTED = "array<struct<row:long,id:long,score:long>>"


def is_finite(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(sound, F.lit(False))


def whole(x: Column) -> Column:
    """The greatest whole number not above x, as a double of any size."""
    return F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)


class Bucket:
    """Vectors of similar length with their sorted coordinate lists."""

    def __init__(self, ids, rows, labels, vectors, orders, shortest: float, longest: float) -> None:
        self.ids, self.rows, self.labels, self.vectors, self.orders = ids, rows, labels, vectors, orders
        self.shortest, self.longest = shortest, longest
        self._sorted: dict[int, np.ndarray] = {}

    @classmethod
    def read(cls, row: dict) -> Bucket:
        ids, rows, labels = [np.frombuffer(row[c], "<i8") for c in ("ids", "rows", "labels")]
        cells = len(ids) * row["width"]
        vectors = np.frombuffer(row["vectors"], "<i2" if len(row["vectors"]) == 2 * cells else "<f8").astype(float).reshape(len(ids), -1)
        orders = np.frombuffer(row["orders"], "<u2" if len(row["orders"]) == 2 * cells else "<u4").reshape(-1, len(ids))
        return cls(ids, rows, labels, vectors, orders, row["shortest"], row["longest"])

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.sqrt((self.vectors * self.vectors).sum(1))

    def sorted_list(self, coordinate: int) -> np.ndarray:
        """That coordinate of the unit vectors, as in ``unit``, in order."""
        if coordinate not in self._sorted:
            order = self.orders[coordinate]
            values, lengths = self.vectors[order, coordinate], self.lengths[order]
            self._sorted[coordinate] = np.divide(values, lengths, out=np.zeros_like(values), where=lengths > 0)
        return self._sorted[coordinate]

    def candidates(self, anchor: np.ndarray, bound: int | None) -> np.ndarray:
        """Positions of all members whose score with the anchor can reach the bound, and perhaps of others."""
        everyone = np.arange(len(self.ids))
        length = float(np.sqrt((anchor * anchor).sum()))
        reach = length * (self.longest if bound is not None and bound > 0 else self.shortest)
        if bound is None or length == 0 or (bound <= 0 and reach == 0):
            return everyone
        cosine = bound / reach if reach else math.inf
        cosine -= 1e-9 * abs(cosine)
        if cosine > 1:
            return everyone[:0]
        if cosine <= -1:
            return everyone
        # The slack covers the rounding of the arc cosine near one.
        angle = math.acos(cosine) + 1e-7
        direction = anchor / length
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        met = np.ones(len(self.ids), bool)
        for f in focus.tolist():
            own = math.acos(min(1.0, max(-1.0, direction[f])))
            low, high = math.cos(min(math.pi, own + angle)) - 1e-9, math.cos(max(0.0, own - angle)) + 1e-9
            values = self.sorted_list(f)
            start, stop = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if start >= stop:
                return everyone[:0]
            if 2 * (stop - start) > len(values):
                met[self.orders[f, :start]] = met[self.orders[f, stop:]] = False
            else:
                inside = np.zeros(len(values), bool)
                inside[self.orders[f, start:stop]] = True
                met &= inside
        return np.flatnonzero(met)

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products with the members at these positions."""
        if float(np.sqrt((anchor * anchor).sum())) * self.longest < EXACT:
            # To pick out many vectors takes longer than to multiply them all.
            products = (self.vectors @ anchor)[at] if 8 * len(at) > len(self.ids) else self.vectors[at] @ anchor
            return products.astype(np.int64)
        whole = [int(x) for x in anchor]
        return np.array([sum(x * int(y) for x, y in zip(whole, v)) for v in self.vectors[at]], dtype=object)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; zero vectors stay."""
    lengths = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def _narrow(components: Column) -> Column:
    """Whether all are whole numbers of two bytes."""
    return F.forall(components, lambda x: F.coalesce(x == x.try_cast("smallint").cast("double"), F.lit(False)))


def _padded(lists: list[list[float]], width: int) -> np.ndarray:
    table = np.zeros((len(lists), width))
    for i, values in enumerate(lists):
        table[i, : len(values)] = values
    return table


def _buckets(rows: DataFrame, count: int, width: int) -> DataFrame:
    """Runs of rows in order of length, each with its sorted coordinate lists."""
    most = max(1, BUCKET_CELLS // width)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def bucket(members: list[dict]) -> dict:
            vectors = _padded([m["components"] for m in members], width)
            lengths = np.sqrt((vectors * vectors).sum(1))
            orders = np.argsort(unit(vectors), axis=0, kind="stable").T.astype("<u2" if len(members) <= 1 << 16 else "<u4")
            small = (np.abs(vectors) < 1 << 15).all() and (vectors == np.floor(vectors)).all()
            numbers = {name: np.array([m[c] for m in members], "<i8").tobytes() for name, c in (("rows", "row"), ("ids", "id"), ("labels", "label"))}
            ends = {"shortest": float(lengths.min()), "longest": float(lengths.max())}
            kept = {"vectors": vectors.astype("<i2" if small else "<f8").tobytes(), "orders": orders.tobytes("C")}
            return {"bucket": members[0]["row"], "width": width, **ends, **numbers, **kept}

        def send(members: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([bucket(members)], BUCKET_ARROW)

        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= most:
                yield send(waiting[:most])
                waiting = waiting[most:]
        if waiting:
            yield send(waiting)

    dealt = rows.repartitionByRange(max(1, math.ceil(count / (4 * most))), "length", "row").sortWithinPartitions("length", "row")
    return dealt.select("row", "id", "label", "components").mapInArrow(build, BUCKET_SCHEMA)


BUCKET_ARROW = pa.schema(
    [("bucket", pa.int64()), ("shortest", pa.float64()), ("longest", pa.float64()), ("width", pa.int32())]
    + [(name, pa.binary()) for name in ("rows", "ids", "labels", "vectors", "orders")]
)
FOUND_ARROW = pa.schema([(part.split()[0], pa.int64()) for part in FOUND_SCHEMA.split(", ")])


def _best(at: np.ndarray, scores: np.ndarray, bucket: Bucket, k: int) -> list[int]:
    """Indexes into ``at`` of the k best: highest score, then smallest id, then row."""
    return sorted(range(len(at)), key=lambda i: (-scores[i], bucket.ids[at[i]], bucket.rows[at[i]]))[:k]


def _search_block(bucket: Bucket, anchors: list[dict], width: int, k: int, least_percent: int) -> Iterator[tuple]:
    """What each anchor finds in a bucket: rows of its label, or for each of its positives rows of other labels."""
    for anchor in anchors:
        vector = _padded([anchor["components"]], width)[0]
        at = bucket.candidates(vector, anchor["bound"])
        positives = anchor["positives"]
        at = at[bucket.labels[at] == anchor["label"] if positives is None else bucket.labels[at] != anchor["label"]]
        at = at[bucket.rows[at] != anchor["row"]]
        if not len(at):
            continue
        scores = bucket.scores(vector, at)
        if anchor["bound"] is not None:
            reached = scores >= anchor["bound"]
            at, scores = at[reached], scores[reached]
        if positives is None:
            wanted = [((None, None, None), np.arange(len(at)))]
        else:
            wanted = []
            for p in positives:
                fits = (100 * scores >= least_percent * p["score"]) & (scores <= p["score"])
                wanted.append(((p["row"], p["id"], p["score"]), np.flatnonzero(fits)))
        for positive, fits in wanted:
            few = fits if len(fits) <= k else _cut(scores, fits, k)
            for i in _best(at[few], scores[few], bucket, k):
                found = few[i]
                yield (anchor["row"], anchor["id"], *positive, int(bucket.rows[at[found]]), int(bucket.ids[at[found]]), int(scores[found]))


def _cut(scores: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """Those that reach the k-th best score, ties included."""
    values = scores[fits]
    return fits[values >= np.partition(values, len(values) - k)[-k]]


def _least_of(found: list[tuple], k: int) -> list[tuple]:
    """Of what anchors find in several buckets, the k best of each anchor and positive: highest score, then smallest id, then row."""
    groups = defaultdict(list)
    for x in found:
        groups[x[0], x[2]].append(x)
    return [x for group in groups.values() for x in heapq.nsmallest(k, group, key=lambda x: (-x[7], x[6], x[5]))]


def _in_every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def _search(
    anchors: DataFrame, buckets: DataFrame, width: int, k: int, least_percent: int, parts: int | None = None
) -> DataFrame:
    """Each anchor's best in all buckets. ``anchors``: row, id, label, components, length, bound, positives.

    The buckets are dealt out in ``parts``, and every block of anchors is sent to each part. Without ``parts`` the buckets
    are those of the sample, whose size is fixed: the blocks are dealt out, and the sample is sent to them. Both are rows
    of one shuffle, not sides of a join, whose planner would take anchors for a small table before they are multiplied.
    """
    count = anchors.count()
    needed = F.when(F.col("bound") > 0, F.try_divide(F.col("bound").cast("double"), F.col("length"))).otherwise(-1.0)
    each = F.struct("row", "id", "label", "components", "bound", "positives")
    n_blocks = max(1, math.ceil(count / BLOCK))
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block")
    blocks = anchors.groupBy(block).agg(F.collect_list(each).alias("anchors"), F.min(F.coalesce(needed, F.lit(-1.0))).alias("needed"))
    if parts:
        blocks = blocks.withColumn("part", _in_every(parts))
        dealt = buckets.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(parts)).cast("int"))
    else:
        parts = math.ceil(n_blocks / SAMPLE_BLOCKS)
        blocks = blocks.withColumn("part", F.pmod("block", F.lit(parts)).cast("int"))
        dealt = buckets.withColumn("part", _in_every(parts))
    both = dealt.unionByName(blocks.drop("block"), allowMissingColumns=True)
    # Within a task the buckets come first.
    met = both.repartitionById(parts, "part").sortWithinPartitions("part", F.col("anchors").isNotNull())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["part"] != part:
                    part, held = row["part"], []
                if row["anchors"] is None:
                    held.append(Bucket.read(row))
                    continue
                found = []
                for bucket in held:
                    # The bucket's vectors can be too short for all anchors of the block.
                    if bucket.longest * (1 + 1e-9) >= row["needed"]:
                        found += _search_block(bucket, row["anchors"], width, k, least_percent)
                if found:
                    columns = [pa.array(c, pa.int64()) for c in zip(*_least_of(found, k))]
                    yield pa.RecordBatch.from_arrays(columns, schema=FOUND_ARROW)

    found = met.mapInArrow(find, FOUND_SCHEMA)
    order = [F.col("score").desc(), F.col("other_id"), F.col("other")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def _with_bounds(anchors: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Anchors with the score of their k-th best in the sample, where there are so many."""
    bound = F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound")
    known = seeds.groupBy(F.col("anchor").alias("row")).agg(bound)
    return anchors.drop("bound").join(known.hint("merge"), "row", "left")


def _with_positives(anchors: DataFrame, positives: DataFrame) -> DataFrame:
    """Anchors with their positives, at most k; those without any are left out."""
    each = F.collect_list(F.struct(F.col("other").alias("row"), F.col("other_id").alias("id"), "score"))
    lists = positives.groupBy(F.col("anchor").alias("row")).agg(each.cast(WANTED).alias("positives"))
    return anchors.drop("positives").join(lists.hint("merge"), "row")


def _just_below(score: Column, percent: int) -> Column:
    """A whole number under that share of a score of at least zero, safe from rounding."""
    return F.floor(score * F.lit(percent / 100 * (1 - 1e-12))) - 1


def mine(vectors: DataFrame, k: int = 5, least_percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` holds vec_id, label, components (whole numbers as doubles) and anchor (boolean). Each anchor's
    positives are its k best other rows of the same label. For each, the k best rows of other labels
    whose score lies between ``least_percent`` of the positive's and the positive's own.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    square = F.aggregate("components", F.lit(0.0), lambda total, x: total + x * x)
    sound = vectors.filter(F.col("label").isNotNull() & is_finite(F.col("components")))
    rows = sound.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce("anchor", F.lit(False)).alias("anchor"),
        "components",
        F.sqrt(square).alias("length"),
    )
    rows = common.written(rows, "vectors")
    narrow = F.bool_and(_narrow(F.col("components"))).alias("narrow")
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("components")).alias("width"), narrow).first()
    count, width = total["rows"], max(1, total["width"] or 0)
    if total["narrow"]:
        rows = rows.withColumn("components", F.col("components").cast("array<smallint>"))
    buckets = common.written(_buckets(rows, count, width), "buckets")
    n_buckets = max(1, math.ceil(count * width / BUCKET_CELLS))
    parts = max(min(n_buckets, PARTS), math.ceil(n_buckets / HELD))
    every = max(1, math.ceil(count / SAMPLE))
    sample = rows.filter(F.pmod(F.xxhash64("row"), F.lit(every)) == 0)
    sample = common.written(_buckets(sample, min(count, SAMPLE), width), "sample")

    none = F.lit(None)
    anchors = rows.filter("anchor").select("row", "id", "label", "components", "length", none.cast("long").alias("bound"), none.cast(WANTED).alias("positives"))
    seeds = _search(anchors, sample, width, k, least_percent)
    bounded = common.written(_with_bounds(anchors, seeds, k), "anchors")
    positives = common.written(_search(bounded, buckets, width, k, least_percent, parts), "positives")

    searching = _with_positives(anchors, positives)
    floor = F.array_min(F.transform("positives", lambda p: F.when(p["score"] >= 0, _just_below(p["score"], least_percent))))
    searching = searching.withColumn("bound", floor).filter("bound is not null")
    seeds = _search(searching, sample, width, k, least_percent)
    # The bound of an anchor is the least over its positives; one with fewer than k in the sample keeps its own.
    reached = seeds.groupBy(F.col("anchor").alias("row"), "positive").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.filter(F.col("n") >= k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("positive", "least"))).alias("least"))
    searching = searching.join(reached.hint("merge"), "row", "left")
    own = F.transform(
        F.filter("positives", lambda p: p["score"] >= 0),
        lambda p: F.coalesce(F.try_element_at("least", p["row"]), _just_below(p["score"], least_percent)),
    )
    searching = common.written(searching.withColumn("bound", F.array_min(own)).drop("least"), "anchors")
    negatives = _search(searching, buckets, width, k, least_percent, parts)
    shown = {c: F.nullif(F.col(c), F.lit(NO_ID)) for c in ("anchor_id", "positive_id", "other_id")}
    return negatives.select(
        shown["anchor_id"].alias("anchor_id"),
        shown["positive_id"].alias("positive_id"),
        "rank",
        shown["other_id"].alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
