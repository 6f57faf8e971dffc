"""How many tasks a large join or grouping is dealt to.

A join or grouping runs in as many tasks as the session has shuffle partitions, and
adaptive execution merges those until each core has one. What a task must hold then
grows with the input. Rows dealt here go to a number of tasks that their count asks
for, which adaptive execution leaves as it is.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame

# Fixed value: about 60 MB of group keys in a task's memory, for each of the groupings that run in it.
ROWS_PER_TASK = 500_000


def tasks_for(df: DataFrame) -> int | None:
    """Tasks of ``ROWS_PER_TASK`` rows each; None if the session's cores are enough, where nothing needs dealing.

    Counts the rows, so ``df`` should be a plain read of files, which answer from their footers.
    """
    needed = ceil(df.count() / ROWS_PER_TASK)
    return needed if needed > df.sparkSession.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """The same rows, equal keys in one of ``tasks`` tasks; unchanged without ``tasks``."""
    return df.repartition(tasks, *keys) if tasks else df
