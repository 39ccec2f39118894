"""Order-dependent folds over many bounded groups, a partition at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Group = dict[str, np.ndarray]


def fold_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable[[Group], Group | None], schema: str
) -> DataFrame:
    """Run `fn` on the ordered rows of each group, given and returned as column arrays.

    Spark shuffles and sorts; a task walks its groups in one pass over the sorted batches, and a group is a slice of their
    arrays, since a data frame for each would cost more than most folds."""

    def each(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        columns = {c: part[c].to_numpy() for c in part.column_names}
        starts = np.unique(first)
        done = [fn({c: v[a:b] for c, v in columns.items()}) for a, b in zip(starts.tolist(), end[starts].tolist())]
        done = [out for out in done if out is not None]
        return pa.table([np.concatenate([out[c] for out in done]) if done else [] for c in target.names], schema=target)

    target = to_arrow_schema(StructType.fromDDL(schema))
    return walk_groups(df, keys, order, each, schema)


def walk_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table],
    schema: StructType | str, weight: Callable[[pa.Table, np.ndarray], np.ndarray] | None = None, most: int = 1 << 19,
) -> DataFrame:
    """Run `fn` on runs of whole groups in order, with the first row and the end of each row's group.

    For work that treats all groups of a run at once; kept in memory are a batch and the group that it leaves open. Where rows
    grow in `fn`, `weight` tells to how many for each group, given the rows and where groups start, and a run ends with the
    group in which that adds up to `most`."""
    keys = list(keys)

    def starts_of(table: pa.Table) -> np.ndarray:
        change = np.zeros(len(table), dtype=bool)
        change[:1] = True
        for k in keys:
            a, b = table[k].slice(1), table[k].slice(0, len(table) - 1)
            same = pc.fill_null(pc.equal(a, b), False).to_numpy() | (a.is_null().to_numpy() & b.is_null().to_numpy())
            change[1:] |= ~same
        return np.flatnonzero(change)

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.append(starts, len(table))
        runs = np.zeros(len(starts), np.int64)
        if weight is not None:
            total = np.cumsum(weight(table, starts))
            runs = (total - 1) // most
        for a, b in pairwise(np.flatnonzero(np.diff(runs, prepend=-1, append=-1)).tolist()):
            lengths = np.diff(edges[a:b + 1])
            first = np.repeat(edges[a:b] - edges[a], lengths)
            part = table.slice(int(edges[a]), int(edges[b] - edges[a]))
            yield from fn(part, first, first + np.repeat(lengths, lengths)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = (new if held is None else pa.concat_tables([held, new])).combine_chunks()
            starts = starts_of(held)
            if len(starts) > 1:
                yield from work(held.slice(0, int(starts[-1])), starts[:-1])
                held = held.slice(int(starts[-1]))
        if held is not None:
            yield from work(held, starts_of(held))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
