"""The request throttle as a state machine, folded over a whole ordered log: ranges in parallel, their tables composed in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, MOST, CLEAN = 0.4, 30.0, 25


def machine() -> tuple[list[tuple[float, int]], np.ndarray, np.ndarray]:
    """(states (delay, clean) from the first one on, next state after an error, next state after a clean request)."""
    states, at, after = [(LEAST, 0)], {(LEAST, 0): 0}, ([], [])
    for delay, clean in states:  # grows until no new state is reached; delays are doublings and halvings of the two bounds
        full = clean + 1 >= CLEAN
        for k, s in enumerate(((min(MOST, delay * 2), 0), (max(LEAST, delay / 2) if full else delay, 0 if full else clean + 1))):
            if s not in at:
                at[s] = len(states)
                states.append(s)
            after[k].append(at[s])
    return states, np.array(after[0], np.int32), np.array(after[1], np.int32)


def power(step: np.ndarray, n: int) -> np.ndarray:
    """The table of ``n`` steps of one kind, by repeated squaring."""
    out = np.arange(len(step), dtype=np.int32)
    while n:
        if n & 1:
            out = step[out]
        step, n = step[step], n >> 1
    return out


def final_state(log: DataFrame) -> DataFrame:
    """delay, clean after all rows of ``log`` (event_id, event_type), by id, rows without one last, and type; one row.

    Each range of ids gives one row, where every state leads to; no task sees the whole log.
    """
    states, error, clean = machine()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, runs, seen = np.arange(len(states), dtype=np.int32), {}, 0

        def on(n: int) -> None:
            nonlocal table
            if n not in runs and len(runs) < 4096:
                runs[n] = power(clean, n)
            table = runs[n][table] if n in runs else power(clean, n)[table]

        for b in batches:
            bad = np.flatnonzero(b.column(0).to_numpy(zero_copy_only=False))
            before = -1
            for p in bad.tolist():
                on(p - before - 1)
                table, before = error[table], p
            on(b.num_rows - before - 1)
            seen += b.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([table.tolist()], pa.list_(pa.int32()))], ["part", "leads"])

    order = [F.col("event_id").isNull(), F.col("event_id"), F.col("event_type")]
    ranges = log.repartitionByRange(*order).sortWithinPartitions(*order).select(F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("bad"))
    # partitions by range are numbered in order
    parts = ranges.mapInArrow(run, "part int, leads array<int>").agg(F.array_sort(F.collect_list(F.struct("part", "leads"))).alias("parts"))
    last = F.aggregate("parts", F.lit(0), lambda s, p: F.get(p["leads"], s))
    named = F.array(*[F.struct(F.lit(d).alias("delay"), F.lit(c).cast("bigint").alias("clean")) for d, c in states])
    return parts.select(F.get(named, last).alias("s")).select("s.delay", "s.clean")
