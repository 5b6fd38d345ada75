"""Windows over long orderings, kept parallel.

A window over one global order, or over a key that holds a large share of all rows, would run
in a single task. Here every row gets its position within its key: rows are counted per key and
time block, the counts are summed up, and a row adds its number within the block. Positions cut
a key into chunks of equal length, and the last rows of a chunk also go to the next one, as far
as a frame reaches back. One plan serves keys of all sizes; it takes no sample and starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.functions.expressions import is_false_positive
from alertloom.params import DEFAULTS, ESCALATE

CHUNK_ROWS = 100_000
#: Rows of one key within so many seconds are numbered in one task.
BLOCK_SECONDS = 60


def time_block(df: DataFrame, column: str, seconds: int = BLOCK_SECONDS) -> Column:
    """Number of the time block, increasing with the column; null comes first."""
    if df.schema[column].dataType.simpleString() == "timestamp":
        at = F.floor(F.unix_micros(column) / 1_000_000)
    else:  # without a zone: counted from its own calendar, so that no zone can reorder it
        day = F.unix_date(F.to_date(column)).cast("bigint")
        at = day * 86_400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    return F.coalesce(F.floor(at / seconds), F.lit(-(1 << 62)))


def positioned(df: DataFrame, keys: Sequence[str], order: Sequence[str], block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Adds ``_key`` (struct of the keys; nulls are equal) and ``_pos``, 0, 1, .. in order within the key.

    ``order`` starts with a time and must be unique within a key.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0))
    rows = df.withColumn("_key", key).withColumn("_block", time_block(df, order[0], block_seconds))
    counts = rows.groupBy("_key", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_key", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_key", "_block").orderBy(*order)
    numbered = rows.withColumn("_nth", F.row_number().over(within)).join(bases, ["_key", "_block"])
    return numbered.withColumn("_pos", F.col("_base") + F.col("_nth") - 1).drop("_block", "_nth", "_base")


def with_halo(rows: DataFrame, reach: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``_chunk`` and ``_halo``: the last ``reach`` rows of a chunk are also halo rows of the next one."""
    size = max(chunk_rows, reach, 1)
    own = F.floor(F.col("_pos") / size)

    def place(chunk: Column, halo: bool) -> Column:
        return F.struct(chunk.alias("_chunk"), F.lit(halo).alias("_halo"))

    both = F.when(F.col("_pos") % size >= size - reach, F.array(place(own, False), place(own + 1, True)))
    return rows.select("*", F.inline(both.otherwise(F.array(place(own, False)))))


def _rolling_rate(df: DataFrame, part: Sequence[str], order: Sequence[str], window: int) -> DataFrame:
    """Differences of running totals: constant work per row whatever the window length."""
    w = Window.partitionBy(*part).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.withColumn("_esc_run", F.sum("_esc").over(running)).withColumn("_fp_run", F.sum("_fp").over(running))

    def back(name: str, n: int) -> Column:
        return F.lag(name, n, 0).over(w)

    def rate(fp: Column, esc: Column) -> Column:
        return F.when(esc > 0, fp / esc).otherwise(0.0)

    return totals.select(
        *df.columns,
        rate(back("_fp_run", 1) - back("_fp_run", window + 1), back("_esc_run", 1) - back("_esc_run", window + 1)).alias(
            "fp_rate_before"
        ),
        rate(F.col("_fp_run") - back("_fp_run", window), F.col("_esc_run") - back("_esc_run", window)).alias(
            "fp_rate_after"
        ),
    )


def rolling_fp_rate(
    df: DataFrame,
    keys: Sequence[str] = ("stream_id",),
    order: Sequence[str] = ("ts", "alert_id"),
    action: str = "action",
    true_label: str = "true_label",
    window: int = DEFAULTS.window,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """False positives among the escalations of the last ``window`` decisions.

    Adds ``fp_rate_before`` (the decisions before this one) and ``fp_rate_after``
    (this one included); 0.0 where nothing was escalated. ``order`` must be
    unique within a key. With no keys the order is global.
    """
    flagged = df.withColumn("_esc", (F.col(action) == ESCALATE).cast("long")).withColumn(
        "_fp", is_false_positive(action, true_label).cast("long")
    )
    rows = with_halo(positioned(flagged, keys, order), window, chunk_rows)
    rated = _rolling_rate(rows, ["_key", "_chunk"], ["_pos"], window)
    return rated.filter(~F.col("_halo")).drop("_halo", "_chunk", "_key", "_pos", "_esc", "_fp")


def rolling_fp_rates(
    df: DataFrame,
    runs: int,
    action: Column,
    keys: Sequence[str] = ("stream_id",),
    order: Sequence[str] = ("ts", "alert_id"),
    true_label: str = "true_label",
    window: int = DEFAULTS.window,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``rolling_fp_rate`` of several runs over the same rows: each row once per ``run`` (1, 2, ..) with its ``action`` there.

    ``action`` is an expression over the columns of ``df`` and ``run``. Rows are numbered and shuffled
    once; they are multiplied behind the shuffle, whose partitions already hold whole chunks.
    """
    rows = with_halo(positioned(df, keys, order), window, chunk_rows).repartition("_key", "_chunk")
    rows = rows.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs)))).withColumn("action", action)
    flagged = rows.withColumn("_esc", (F.col("action") == ESCALATE).cast("long")).withColumn(
        "_fp", is_false_positive("action", true_label).cast("long")
    )
    rated = _rolling_rate(flagged, ["_key", "_chunk", "run"], ["_pos"], window)
    return rated.filter(~F.col("_halo")).drop("_halo", "_chunk", "_key", "_pos", "_esc", "_fp")
