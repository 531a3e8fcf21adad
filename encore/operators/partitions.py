"""Per-partition user code (X2): lazy, batch-by-batch ``mapInPandas``; work and counts by partition index."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.time import EPOCH_RANGE, from_epoch_seconds


def _whole(text) -> int | None:
    """The 64-bit integer that a field states exactly, as SQL's cast reads it."""
    if not isinstance(text, str) or not re.fullmatch(r"\s*[+-]?\d+\s*", text, re.ASCII):
        return None
    value = int(text)
    return value if -(2 ** 63) <= value < 2 ** 63 else None


def _finite(text) -> float | None:
    try:
        value = float(text) if isinstance(text, str) and "_" not in text else math.nan
    except ValueError:
        return None
    return value if math.isfinite(value) else None


def _parse_batches(batches):
    """Parse each Arrow batch as it arrives; nothing is buffered across batches."""
    for pdf in batches:
        parts = pdf["value"].astype(object).str.split(",", expand=True, regex=False).astype(object)
        parts = parts.reindex(columns=range(max(7, parts.shape[1])))
        good = parts[6].isna() & parts[5].notna()
        whole = {i: pd.Series([_whole(x) for x in parts[i]], parts.index, dtype=object) for i in range(3)}
        played = pd.Series([_finite(x) for x in parts[3]], parts.index, dtype=object)
        for field in (*whole.values(), played):
            good &= field.notna()
        good &= np.array([s is not None and EPOCH_RANGE[0] <= s <= EPOCH_RANGE[1] for s in whole[2]], bool)
        num = {i: whole[i][good].tolist() for i in whole}
        end = parts[5][good].astype(object)
        yield pd.DataFrame({
            "user_id": np.array(num[0], "int64"),
            "track_id": np.array(num[1], "int64"),
            "epoch": np.array(num[2], "int64"),
            "ms_played": played[good].to_numpy(dtype="float64"),
            "reason_start": parts[4][good].astype(object).to_numpy(),
            "reason_end": end.where(end != "null", None).to_numpy(),
        })


def parse_daily_in_pandas(lines: DataFrame) -> DataFrame:
    """P1 as per-partition pandas code; same result as ``parse_daily``."""
    parsed = lines.mapInPandas(
        _parse_batches,
        "user_id long, track_id long, epoch long, ms_played double, reason_start string, "
        "reason_end string")
    return parsed.select("user_id", "track_id", from_epoch_seconds(F.col("epoch")).alias("ts"),
                         "ms_played", "reason_start", "reason_end")


def map_with_index(df: DataFrame, work: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                   schema: str) -> DataFrame:
    """``work`` on each partition's batches, given the partition's index."""
    def run(batches):
        from pyspark import TaskContext
        yield from work(TaskContext.get().partitionId(), batches)
    return df.mapInPandas(run, schema)


def step_counts(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, partition, n_rows): how many of a partition's rows reach each step.

    ``steps`` gives each step's condition on ``df``'s rows; a row counts where it
    is true. Counted in the partitions that ``df`` is read in, in one pass. The
    counts are rows of a table, not accumulators: those of a task that fails or is
    run twice are never added.
    """
    counts = [F.count(F.when(reached, F.lit(1))).alias(step) for step, reached in steps.items()]
    one = df.groupBy(F.spark_partition_id().alias("partition")).agg(*counts)
    return one.unpivot("partition", list(steps), "step", "n_rows").select("step", "partition", "n_rows")
