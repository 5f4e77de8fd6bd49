"""Row numbers without gaps, from the counts of the tasks that wrote the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Below this bit a number of ``monotonically_increasing_id`` counts rows, above it tasks.
TASK_BIT = 33


def row_number_of_write() -> Column:
    """The number a row gets when it is written: its task, then its place in the task."""
    return F.monotonically_increasing_id()


def with_ids(written: DataFrame, name: str, row: str, start: int = 0) -> DataFrame:
    """Adds ids from ``start + 1`` on, unique and without gaps, in the order of ``row``, which is dropped.

    ``row`` holds the numbers of ``row_number_of_write`` as they were written, all of them: within a task they
    have no gaps. The tasks' counts are one line a task; their running sum says where each task's ids
    begin. So no rows are shuffled or sorted, and the ids are the same each time.
    """
    task = F.shiftright(F.col(row), TASK_BIT)
    counts = written.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    starts = counts.select("_task", before.alias("_before"))
    # One line a task that wrote rows.
    numbered = written.withColumn("_task", task).join(F.broadcast(starts), "_task")
    place = F.col(row).bitwiseAND(F.lit((1 << TASK_BIT) - 1))
    return numbered.select((F.lit(start + 1) + F.col("_before") + place).alias(name), *[c for c in written.columns if c != row])
