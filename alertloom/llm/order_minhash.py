"""Document fingerprints by Order MinHash, in DataFrame operations only.

The items of a text are its word k-mers, each numbered among its equals. Every item has one
hash, whose leading bits name the one of ``SLOTS`` sketch functions that is its own. A function
orders all items: first its own, by their hash, then the others, by a hash mixed anew with the
function's number. The ``TUPLE`` least items are selected, put back in text order, and hashed as
a tuple. Agreement of two fingerprints falls with edits and with changes of order, unlike that of
sets of items. A function with ``TUPLE`` items of its own needs no other hash, which keeps the work
linear in long texts; only the functions that a short text leaves short of items mix all of its
items anew. The order depends on item and function alone, so short and long texts compare.

Edited texts need the next document. Documents are dealt into blocks of consecutive ids whose
bounds are approximate percentiles, found in one aggregate of the id column; the top document
of a block also visits the block above it as a guest. So texts are shuffled once, no block is
joined with another, and block bounds (as many as tasks, times ``BLOCKS_PER_TASK``) are one small array.

Nulls: a null text is empty and has an empty fingerprint; empty fingerprints are alike (1.0), and
unlike any other (0.0). Null doc_ids come after all others. Repeated rows follow each other in
order of their texts. A single document is its own next. Texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.common import WORD

K = 3
TUPLE = 2
SLOT_BITS = 6
SLOTS = 1 << SLOT_BITS
#: Bits of an item that hold its place in the text; the others hold its hash. Places of more than
#: 67 million words would run into the hash: still one result for equal texts, but a coarser hash.
PLACE_BITS = 26
TUPLE_BITS = 32 - SLOT_BITS
BLOCKS_PER_TASK = 8


def _slot(item: Column) -> Column:
    return F.shiftright(item, 64 - SLOT_BITS)


def _hash(item: Column) -> Column:
    return F.shiftright(item, PLACE_BITS)


def _item(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hashed, PLACE_BITS), PLACE_BITS).bitwiseOR(place.cast("long"))


def _upto(n: Column) -> Column:
    """0 .. n - 1, empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, an array of ints: the slot in the leading bits, the tuple's hash in the others."""
    words, items, ordered, chosen, leads, owners = (
        f"_{out}_{n}" for n in ("words", "items", "ordered", "chosen", "leads", "owners")
    )
    df = df.withColumn(words, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)))
    count = F.when(F.size(words) > 0, F.greatest(F.size(words) - (K - 1), F.lit(1))).otherwise(0)
    # a text of fewer than K words is one item; xxhash64 passes over the missing words
    grams = F.transform(_upto(count), lambda i: _item(F.xxhash64(*[F.get(words, i + j) for j in range(K)]), i))
    df = df.withColumn(items, grams).withColumn(ordered, F.sort_array(items))

    def begins(j: Column) -> Column:
        return (j == 0) | (_hash(F.get(ordered, j)) != _hash(F.get(ordered, j - 1)))

    # runs of equal k-mers get numbers within the run; all but the first occurrence are hashed anew
    runs = F.filter(_upto(F.size(ordered)), begins)
    run = F.transform(
        F.zip_with(runs, F.concat(F.slice(runs, 2, F.size(ordered)), F.array(F.size(ordered))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda r: F.transform(
            F.sequence(F.lit(0), r["b"] - r["a"] - 1),
            lambda n: F.when(n == 0, F.get(ordered, r["a"])).otherwise(
                _item(F.xxhash64(_hash(F.get(ordered, r["a"])), n), F.get(ordered, r["a"] + n).bitwiseAND((1 << PLACE_BITS) - 1))
            ),
        ),
    )
    distinct = F.size(F.array_distinct(F.transform(items, _hash))) == F.size(items)
    df = df.withColumn(ordered, F.when(distinct, F.col(ordered)).otherwise(F.sort_array(F.flatten(run))))
    least = F.filter(ordered, lambda x, j: (j < TUPLE) | (_slot(F.get(ordered, j - TUPLE)) != _slot(x)))
    df = df.withColumn(chosen, least)
    first_own = F.filter(
        _upto(F.size(chosen)),
        lambda j: (j == 0) | (_slot(F.get(chosen, j)) != _slot(F.get(chosen, j - 1))),
    )
    df = df.withColumn(leads, first_own).withColumn(owners, F.transform(leads, lambda j: _slot(F.get(chosen, j)).cast("int")))
    mask = (1 << PLACE_BITS) - 1

    def tupled(first: Column, second: Column) -> Column:
        swapped = first.bitwiseAND(mask) > second.bitwiseAND(mask)
        return F.when(swapped, F.xxhash64(_hash(second), _hash(first))).otherwise(F.xxhash64(_hash(first), _hash(second)))

    def anew(f: Column) -> Column:
        """The two least of all items by the function's other hash."""
        mixed = F.transform(ordered, lambda x: _item(F.xxhash64(_hash(x), f), x.bitwiseAND(mask)))
        return F.slice(F.sort_array(mixed), 1, TUPLE)

    def other(f: Column, own: Column) -> Column:
        """The least item by the function's other hash that is not ``own``."""
        mixed = F.transform(
            F.filter(ordered, lambda x: x != own), lambda x: _item(F.xxhash64(_hash(x), f), x.bitwiseAND(mask))
        )
        return F.array_min(mixed)

    def once(value: Column, then) -> Column:
        """``then`` of a value computed once, also where it is used for every item."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def slot(f: Column) -> Column:
        return once(F.get(leads, F.array_position(owners, f).cast("int") - 1), lambda at: slot_at(f, at))

    def slot_at(f: Column, at: Column) -> Column:
        first, second = F.get(chosen, at), F.get(chosen, at + 1)
        paired = F.coalesce(_slot(first) == _slot(second), F.lit(False))
        hashed = (
            F.when(F.size(ordered) == 1, F.xxhash64(_hash(F.get(ordered, F.lit(0)))))
            .when(paired, tupled(first, second))
            .when(first.isNotNull(), once(first, lambda own: once(other(f, own), lambda o: tupled(own, o))))
            .otherwise(once(anew(f), lambda two: tupled(F.get(two, F.lit(0)), F.get(two, F.lit(1)))))
        )
        low = F.shiftrightunsigned(hashed, 64 - TUPLE_BITS)
        return F.shiftleft(f, TUPLE_BITS).bitwiseOR(low).cast("int")

    functions = F.when(F.size(ordered) > 0, F.sequence(F.lit(-SLOTS // 2), F.lit(SLOTS // 2 - 1)))
    prints = F.transform(F.coalesce(functions, F.array().cast("array<int>")), slot)
    return df.withColumn(out, prints).drop(words, items, ordered, chosen, leads, owners)


def as_text(signature: str) -> Column:
    return F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")))


def likeness(a: str, b: str) -> Column:
    """Share of the functions used by either that agree."""
    used = F.array_union(*[F.transform(c, lambda x: F.shiftright(x, TUPLE_BITS)) for c in (a, b)])
    agreeing = F.size(F.array_intersect(a, b)) / F.size(used)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(agreeing)


def with_next(docs: DataFrame, columns: tuple[str, ...], blocks: int | None = None) -> DataFrame:
    """Adds ``next_<column>`` of the next document by descending doc_id, the first after the last."""
    blocks = blocks or BLOCKS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit((k + 1) / blocks) for k in range(blocks)])
    tops = docs.agg(F.array_distinct(F.percentile_approx("doc_id", shares, 100 * blocks)).alias("tops"))
    rows = docs.withColumn("_tops", F.coalesce(tops.scalar(), F.array().cast("array<long>")))
    steps = F.array(*[F.lit(1 << k) for k in range(blocks.bit_length(), -1, -1)])

    def search(found: Column, step: Column) -> Column:
        below = F.coalesce(F.get("_tops", found + step - 1) < F.col("doc_id"), F.lit(False))
        return F.when(below, found + step).otherwise(found)

    rows = rows.withColumn("_block", F.aggregate(steps, F.lit(0), search))
    last = F.greatest(F.size("_tops") - 1, F.lit(0))
    top = (F.get("_tops", F.col("_block")) == F.col("doc_id")) | (F.size("_tops") == 0)
    above = F.when(F.col("_block") >= last, 0).otherwise(F.col("_block") + 1)
    own, guest = (F.struct(b.alias("block"), F.lit(g).alias("guest")) for b, g in ((F.col("_block"), False), (above, True)))
    stays = F.when(F.coalesce(top, F.lit(False)), F.array(own, guest)).otherwise(F.array(own))
    dealt = rows.withColumn("_stay", F.explode(stays)).drop("_tops", "_block")
    dealt = dealt.withColumn("_block", F.col("_stay.block")).withColumn("_guest", F.col("_stay.guest")).drop("_stay")
    dealt = dealt.withColumn("_tie", F.xxhash64("text"))
    order = Window.partitionBy("_block").orderBy("_guest", F.desc_nulls_last("doc_id"), "_tie", "text")
    dealt = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return dealt.filter(~F.col("_guest")).drop("_block", "_guest", "_tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_signature(rows, "text", "signature"), ("text", "signature"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("n_chars", n.cast("long")).drop("text", "next_text")
    rows = with_signature(rows, "edited", "edited_signature")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("signature").alias("fingerprint"),
        as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
    )


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
