"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue served in proportion to its target. A shuffled document has a
virtual finish time: the words of its source served up to its end, divided by the source's
target. All sources reach their target at virtual time 1, so sorting by virtual time and
stopping at the total budget gives the mix. A source whose target exceeds its size is
served again from its start, up to ``max_passes`` times.

Hot sources: running totals per source are built from slots of the shuffle order (by hash),
so a source is spread over all tasks. The order by virtual time needs no sample: sources
advance at constant rates, so equal slots of virtual time hold about equally many words.
Only ids and sizes are shuffled. One row per source meets in one task to rank the sources.

Nulls: a null text has size 0, a null source is a source of its own that comes last, a null
doc_id is an id like others. Repeated rows are documents of their own. Sizes of 0 take
nothing; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.common import WORD, stored, without

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SLOT_DIGITS = 3
TIME_SLOTS = 1024

ADDED = ("size", "source_size", "target", "mix_pass", "mix_words", "mix_finish", "mix_start")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, _rank, source_size, target`` from rows of ``source, size``.

    With caps sorted by cap / weight, the level that caps leave for the others rises until the
    first source below its cap and falls afterwards, so the level is the maximum over all prefixes.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("_rank", F.row_number().over(by_name)).withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    )
    by_cap = Window.orderBy(F.col("source_size") / F.col("_weight"), "_rank")
    before, all_rows = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_weight").over(all_rows) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("_cap", F.col("source_size") * max_passes).withColumn("_level", level)
    return levels.select(
        "source",
        "_rank",
        "source_size",
        F.least(F.col("_cap").cast("double"), F.max("_level").over(all_rows) * F.col("_weight")).alias("target"),
    )


def queued(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Rows of ``doc_id, source, size`` with ``source_size, target`` and ``_start``, the words queued before."""
    targets = source_targets(docs.select("source", "size"), weights, max_passes)
    rows = docs.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.drop("_source").withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = rows.withColumn("_slot", F.substring("_key", 1, SLOT_DIGITS))
    slots = rows.groupBy("_rank", "_slot").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_rank").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("_rank", "_slot", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_rank", "_slot").orderBy("_key", "doc_id", "size")
    ahead = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_ahead", ahead).join(slots, ["_rank", "_slot"])
    return rows.withColumn("_start", F.col("_base") + F.col("_ahead")).drop("_slot", "_ahead", "_base", "_key")


def _mixed(rows: DataFrame, max_passes: int) -> DataFrame:
    """Copies of queued rows that the mix takes, with finish time, words and place in the mix.

    Units of service are sorted by finish time and served until the budget is used up. A copy that
    ends by time 1 is one unit; one that is in service then is served word by word, so that the cut
    gives it the words served by then. Each source offers a word beyond its target at least, if it
    has one; what the order puts past the budget is cut off.
    """
    budget = rows.groupBy("_rank").agg(F.first("target").alias("t")).agg(F.sum(F.floor("t"))).first()[0] or 0
    passes = F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))
    copies = rows.filter("size > 0").withColumn("mix_pass", passes)
    copies = copies.withColumn("_begin", F.col("source_size") * F.col("mix_pass") + F.col("_start"))
    offered = F.floor("target") + 1 - F.col("_begin")
    copies = copies.filter(offered > 0).withColumn("_whole", F.col("_begin") + F.col("size") <= F.col("target"))
    words = F.sequence(F.lit(0).cast("long"), F.least("size", offered) - 1)
    units = copies.withColumn("_at", F.explode(F.when(F.col("_whole"), F.array(F.lit(0).cast("long"))).otherwise(words)))
    units = units.withColumn("_words", F.when(F.col("_whole"), F.col("size")).otherwise(1))
    units = units.withColumn("_from", F.col("_begin") + F.col("_at"))
    units = units.withColumn("mix_finish", (F.col("_from") + F.col("_words")) / F.col("target"))
    served = _placed(units, "_words", "_from", "_at")
    served = served.withColumn("mix_words", F.least(F.col("_words"), F.lit(budget) - F.col("_before"))).filter("mix_words > 0")
    columns = [*rows.columns, "mix_pass", "_begin"]
    whole = served.filter("_whole").select(*columns, "mix_words", "mix_finish")
    cut = served.filter("NOT _whole").groupBy(*columns)
    cut = cut.agg(F.sum("mix_words").alias("mix_words"), F.max("mix_finish").alias("mix_finish"))
    # a copy that was served word by word has its place where its last word was
    placed = _placed(whole.unionByName(cut), "mix_words", "_begin", "mix_pass")
    return placed.withColumnRenamed("_before", "mix_start").drop("_begin")


def _placed(units: DataFrame, words: str, *ties: str) -> DataFrame:
    """``units`` with ``_before``, the words of all units that finish earlier. What finishes after time 1 is in a last slot."""
    units = units.withColumn("_time", F.least(F.floor(F.col("mix_finish") * TIME_SLOTS), F.lit(TIME_SLOTS)))
    slots = units.groupBy("_time").agg(F.sum(words).alias("_sum"))
    earlier = Window.orderBy("_time").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("_time", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_time").orderBy("mix_finish", "_rank", *ties)
    ahead = F.coalesce(F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = units.withColumn("_ahead", ahead).join(slots, "_time").withColumn("_before", F.col("_base") + F.col("_ahead"))
    return placed.drop("_time", "_ahead", "_base")


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Queue (one row per document) and mix (one row per copy taken) without texts.

    Queue: ``doc_id, source, size, source_size, target, _rank, _start``; a document is known
    by ``_rank, _start, doc_id``. The mix adds ``mix_pass, mix_words, mix_finish, mix_start``;
    its order is ``mix_start`` and its words sum to the total budget but for fractions.
    """
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    # written, as sizes and queue are read several times and texts should be read once
    sizes = stored(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    queue = stored(queued(sizes, weights, max_passes), "mix-queue")
    return queue, _mixed(queue, max_passes)


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """The mixed corpus: each row of ``docs`` once per pass taken, a part served in part cut to its words.

    Rows with equal doc_id share their passes out by size. ``n_chars`` follows the text where it exists.
    """
    _, mix = mix_plan(docs, weights, max_passes)
    keyed = without(docs, ["_id", "_from", "_size", "_copy", *ADDED])
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")

    def keys(rows: DataFrame, size: Column) -> DataFrame:
        # two nulls are equal here; the sign in front keeps them from any text
        named = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("doc_id", "source")]
        return rows.withColumns({"_id": named[0], "_from": named[1], "_size": size})

    same = ["_id", "_from", "_size"]
    # repeated rows of one id are told apart by number; an id's rows are few
    keyed = keys(keyed, size).withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy("text")))
    nth = F.dense_rank().over(Window.partitionBy(*same).orderBy("_start"))
    mix = keys(mix, F.col("size")).withColumn("_twin", nth).select(*same, "_twin", *ADDED[3:])
    # a range, not an equality, so that texts stay where the window has put them
    joined = keyed.join(mix, same).filter(F.col("_copy").between(F.col("_twin"), F.col("_twin")))
    parts = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.concat_ws("", F.slice(parts, 1, F.col("mix_words").cast("int")))
    joined = joined.withColumn("text", F.when(F.col("mix_words") < F.col("_size"), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.drop("_id", "_from", "_size", "_copy", "_twin")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    queue, mix = mix_plan(docs)
    row = ["_rank", "_start", "doc_id", "size"]
    taken = mix.groupBy(*row).agg(F.sum("mix_words").alias("_taken"))
    taken = taken.select(*[F.col(c).alias(f"_{c}") for c in row], "_taken")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in row]
    return queue.join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken")
    )


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS place FROM totals
), weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM ranked
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
          / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, place, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), queue AS (
  SELECT s.doc_id, s.size, t.place, t.source_size, t.target, row_number() OVER () AS row_id,
         coalesce(sum(s.size) OVER (PARTITION BY t.place ORDER BY md5(coalesce(s.doc_id::VARCHAR, 'null')), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, CAST(start + p * source_size AS BIGINT) AS begin, CAST(floor(target) AS BIGINT) AS goal
  FROM queue, range(3) r(p) WHERE size > 0
), units AS (
  SELECT *, begin + size <= target AS whole,
         unnest(CASE WHEN begin + size <= target THEN [0] ELSE range(0, least(size, goal + 1 - begin)) END) AS word
  FROM copies WHERE begin < goal + 1
), served AS (
  SELECT row_id, CASE WHEN whole THEN size ELSE 1 END AS words,
         sum(CASE WHEN whole THEN size ELSE 1 END) OVER (ORDER BY (begin + word + CASE WHEN whole THEN size ELSE 1 END) / target, place, begin + word
           ROWS UNBOUNDED PRECEDING) AS upto
  FROM units
), taken AS (
  SELECT row_id, sum(greatest(0, least(words, (SELECT sum(floor(target)) FROM targets) - (upto - words)))) AS taken FROM served GROUP BY row_id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queue LEFT JOIN taken USING (row_id)
"""
