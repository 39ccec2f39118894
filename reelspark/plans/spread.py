"""Dealing a listing out to tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Tasks for each core, so that tasks of unlike files even out.
PER_CORE = 8


def spread(files: DataFrame, *keys: str, per_core: int = PER_CORE) -> DataFrame:
    """The rows dealt out by `keys`, to a given number of tasks.

    The number is given, since adaptive execution would merge partitions by their bytes: a listing is small, the files
    that it names are not."""
    return files.repartition(per_core * files.sparkSession.sparkContext.defaultParallelism, *keys)
