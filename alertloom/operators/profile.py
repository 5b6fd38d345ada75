"""Profiling of raw tables. Each operator reads its input once and shuffles only partial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, NumericType

from alertloom.params import LABEL_COL


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), types: tuple = (NumericType,)) -> list[str]:
    """Numeric columns in schema order, chosen by type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in exclude]


def profile_numeric_columns(df: DataFrame, exclude: Sequence[str] = ("difficulty",)) -> list[str]:
    """Integer, long and double columns, as the profiling steps use them."""
    return numeric_columns(df, exclude, (IntegerType, LongType, DoubleType))


def columns_except(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def _wide_to_long(one_row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row of structs -> one row per column."""
    entries = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}`.{f}").alias(f) for f in fields]) for c in columns]
    return one_row.select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that have nulls, with the number of nulls."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("null_count")).alias(c) for c in columns])
    return _wide_to_long(counts, columns, ["null_count"]).filter("null_count > 0")


def class_distribution(df: DataFrame, column: str = LABEL_COL) -> DataFrame:
    """Rows per class with the percentage of the total, largest class first."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = Window.partitionBy()
    return counts.select(
        column, "n", F.round(F.col("n") / F.sum("n").over(total) * 100, 2).alias("pct")
    ).orderBy(F.desc("n"), column)


def categorical_profile(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Per column the number of distinct values and the most frequent ones.

    The rank filter is pushed below the shuffle of the counts, so a column with
    very many values sends only ``top`` of them per task.
    """
    texts = df.select([F.col(c).cast("string").alias(c) for c in columns])
    values = texts.unpivot([], list(columns), "column", "value")
    counts = values.groupBy("column", "value").agg(F.count("*").alias("n"))
    # counted through ``n`` so that both branches need the same columns and share one shuffle
    distinct = counts.groupBy("column").agg(F.count_if(F.col("n") > 0).alias("n_values"))
    ranked = counts.withColumn(
        "rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value")))
    ).filter(F.col("rank") <= top)
    # one row per listed column, so the broadcast side is as long as ``columns``
    return ranked.join(F.broadcast(distinct), "column").select("column", "n_values", "rank", "value", "n")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max per column as numbers."""
    fields = ["n", "mean", "stddev", "min", "max"]
    stats = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return _wide_to_long(stats, columns, fields)


def quasi_constant(df: DataFrame, columns: Sequence[str], limit: float = 0.01) -> DataFrame:
    """Columns whose sample standard deviation is below the limit."""
    stats = df.agg(*[F.struct(F.stddev(c).alias("std_dev")).alias(c) for c in columns])
    return _wide_to_long(stats, columns, ["std_dev"]).filter(F.col("std_dev") < limit)


def label_correlation(df: DataFrame, columns: Sequence[str], label: str = LABEL_COL, top: int = 15) -> DataFrame:
    """Pearson correlation of each column with the class index, strongest first.

    The index follows class frequency, so it is known only after a count. Rather
    than joining it back to the rows, one pass takes count, mean and variance per
    class and column; the correlation follows from those few rows because the
    index is constant within a class. Constant columns are left out.
    """
    numbers = df.filter(F.col(label).isNotNull()).select(label, *[F.col(c).cast("double").alias(c) for c in columns])
    moments = [
        F.struct(
            F.count(c).cast("double").alias("k"),
            F.avg(c).alias("m"),
            F.var_pop(c).alias("v"),
        ).alias(c)
        for c in columns
    ]
    per_class = numbers.groupBy(label).agg(F.count("*").alias("_rows"), *moments)
    # one row per class so far; only those are spread over the columns
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("s")) for c in columns])
    stats = per_class.select(label, F.col("_rows").alias("rows"), F.explode(cells).alias("c")).select(
        label, "rows", F.col("c.column").alias("column"), "c.s.*"
    )
    # over classes x columns rows: those of one class are peers
    by_frequency = Window.partitionBy().orderBy(F.desc("rows"), label)
    indexed = stats.withColumn("y", (F.dense_rank().over(by_frequency) - 1).cast("double")).filter("k > 0")
    sums = indexed.groupBy("column").agg(
        # exact: equal numbers of a class have no variance, and equal classes one mean
        ((F.max("v") > 0) | (F.max("m") > F.min("m"))).alias("varies"),
        (F.sum(F.col("k") * F.col("m")) / F.sum("k")).alias("mean_x"),
        (F.sum(F.col("k") * F.col("y")) / F.sum("k")).alias("mean_y"),
        F.collect_list(F.struct("k", "m", "v", "y")).alias("groups"),  # one entry per class
    )

    def total(expr):
        return F.aggregate("groups", F.lit(0.0), lambda acc, g: acc + g["k"] * expr(g))

    spread = sums.filter("varies").select(
        "column",
        total(lambda g: (g["m"] - F.col("mean_x")) * (g["y"] - F.col("mean_y"))).alias("sxy"),
        total(lambda g: g["v"] + (g["m"] - F.col("mean_x")) * (g["m"] - F.col("mean_x"))).alias("sxx"),
        total(lambda g: (g["y"] - F.col("mean_y")) * (g["y"] - F.col("mean_y"))).alias("syy"),
    )
    corr = spread.filter(F.col("syy") > 0).withColumn(
        "corr", F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy"))
    )
    return (
        corr.select("column", "corr", F.abs("corr").alias("corr_abs"))
        .orderBy(F.desc("corr_abs"), "column")
        .limit(top)
    )


def class_shift(train: DataFrame, test: DataFrame, column: str = LABEL_COL) -> DataFrame:
    """Class counts of two tables side by side with their shares and the difference."""
    left = train.groupBy(column).agg(F.count("*").alias("train"))
    right = test.groupBy(column).agg(F.count("*").alias("test"))
    total = Window.partitionBy()
    both = left.join(right, column, "full_outer").select(
        column, F.coalesce("train", F.lit(0)).alias("train"), F.coalesce("test", F.lit(0)).alias("test")
    )
    shares = both.select(
        "*",
        F.round(F.try_divide(F.col("train") * 100.0, F.sum("train").over(total)), 2).alias("train_pct"),
        F.round(F.try_divide(F.col("test") * 100.0, F.sum("test").over(total)), 2).alias("test_pct"),
    )
    return shares.withColumn("diff_pct", F.round(F.col("test_pct") - F.col("train_pct"), 2))


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(n).select(*columns)
