"""SQL twins of the queries over the order tables, written from their definitions."""

from __future__ import annotations

from alertloom.plans.order_queries import CONSTANT_LIMIT, EXTERNAL_FROM, FOLDS
from alertloom.sources.tables import ORDER_CATEGORIES, ORDER_CLASS, ORDER_CLASSES, ORDER_NUMBERS

SPLITS = ("train", "val", "test")
# how many values the generated tables hold: the columns of a SQL text are fixed, the fitted stages count theirs
CATEGORY_SIZES = {"o_orderstatus": 3, "c_mktsegment": 5, "r_name": 5}
IS_KNOWN = f"{ORDER_CLASS} IN ({', '.join(repr(c) for c in ORDER_CLASSES)})"


def draw(salt: str) -> str:
    return f"(('0x'||substr(md5(o_orderkey::VARCHAR||':{salt}'),1,8))::BIGINT / 4294967296.0::DOUBLE)"


def r(expr: str) -> str:
    return f"(round(({expr})::DOUBLE, 6) + 0.0::DOUBLE)"


def cents(column: str) -> str:
    return f"round({column} * 100)::BIGINT"


SPLIT = f"CASE WHEN {draw('split')} < 0.70 THEN 'train' WHEN {draw('split')} < 0.85 THEN 'val' ELSE 'test' END"
RECORDS = f"""
records AS MATERIALIZED (
  SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, c_mktsegment, r_name, o_totalprice, c_acctbal,
         coalesce(n, 0) AS n_lines, quantity, revenue, discount, tax, n_parts, part_size, retail,
         date_diff('day', o_orderdate, shipped)::INTEGER AS ship_days
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity,
           sum({cents('l_extendedprice')} * (100 - {cents('l_discount')}))::DOUBLE / 10000.0::DOUBLE AS revenue,
           sum({cents('l_discount')})::DOUBLE / (count(l_discount) * 100)::DOUBLE AS discount,
           sum({cents('l_tax')})::DOUBLE / (count(l_tax) * 100)::DOUBLE AS tax,
           count(p_partkey) AS n_parts, sum(p_size)::DOUBLE / nullif(count(p_size), 0)::DOUBLE AS part_size,
           sum({cents('p_retailprice')})::DOUBLE / 100.0::DOUBLE AS retail, max(l_shipdate) AS shipped
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey)"""
KNOWN = f"known AS MATERIALIZED (SELECT *, {SPLIT} AS split FROM records WHERE {IS_KNOWN})"
VOCAB = [
    f"v_{c} AS MATERIALIZED (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i "
    f"FROM known WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c})"
    for c in ORDER_CATEGORIES
]
JOINS = " ".join(f"LEFT JOIN v_{c} ON v_{c}.v = known.{c}" for c in ORDER_CATEGORIES)
HOT = [f"(CASE WHEN v_{c}.i = {j} THEN 1.0 ELSE 0.0 END)::DOUBLE" for c in ORDER_CATEGORIES for j in range(CATEGORY_SIZES[c])]
SLOTS = [f"f{i:02d}" for i in range(len(ORDER_NUMBERS) + len(HOT))]
FEATURES = (
    f"feats AS MATERIALIZED (SELECT o_orderkey, split, {ORDER_CLASS}, "
    + ", ".join(f"({e})::DOUBLE AS {s}" for s, e in zip(SLOTS, [*ORDER_NUMBERS, *HOT], strict=True))
    + f" FROM known {JOINS} WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ORDER_NUMBERS)
    + ")"
)
WEIGHTS = (
    f"weights AS (SELECT {ORDER_CLASS}, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / ({len(ORDER_CLASSES)} * count(*)), 4) AS weight "
    f"FROM known WHERE split = 'train' GROUP BY {ORDER_CLASS})"
)


def over(select: str, *ctes: str) -> str:
    return "WITH " + ", ".join([RECORDS, *ctes]) + " " + select


def stacked(parts) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def profile_of(columns, table: str, top: int) -> str:
    """Values of each column by how often they occur; nulls come first among equals."""
    counts = stacked(
        f"SELECT '{c}' AS \"column\", count(*) OVER () AS n_values, "
        f"(row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR NULLS FIRST))::INTEGER AS rank, {c}::VARCHAR AS value, "
        f"count(*) AS n FROM {table} GROUP BY {c}"
        for c in columns
    )
    return f"SELECT * FROM ({counts}) WHERE rank <= {top}"


ROUNDED = ("revenue", "discount", "tax", "part_size", "retail")
ORDER_ORACLES = {
    "order_records": over(f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in ROUNDED)}) FROM records"),
    "order_null_profile": over(
        "SELECT * FROM ("
        + stacked(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count FROM records"
            for c in ("o_orderkey", "o_orderdate", ORDER_CLASS, *ORDER_CATEGORIES, *ORDER_NUMBERS)
        )
        + ") WHERE null_count > 0"
    ),
    "order_class_distribution": f"SELECT {ORDER_CLASS}, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 2) AS pct "
    f"FROM orders GROUP BY {ORDER_CLASS}",
    "order_categorical_profile": over(profile_of([ORDER_CLASS, *ORDER_CATEGORIES], "records", 3)),
    "part_categorical_profile": profile_of(["p_brand", "p_type", "p_size", "p_name"], "part", 10),
    "order_describe_numeric": over(
        stacked(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS stddev, "
            f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM records"
            for c in ORDER_NUMBERS
        )
    ),
    "order_quasi_constant": over(
        f"SELECT \"column\", {r('sd')} AS std_dev FROM ("
        + stacked(f"SELECT '{c}' AS \"column\", stddev_samp({c}) AS sd FROM records" for c in ORDER_NUMBERS)
        + f") WHERE sd < {CONSTANT_LIMIT}"
    ),
    "order_label_correlation": over(
        f"SELECT \"column\", {r('c')} AS corr, {r('abs(c)')} AS corr_abs FROM ("
        + stacked(
            f"SELECT '{c}' AS \"column\", corr({c}::DOUBLE, y::DOUBLE) AS c FROM indexed HAVING min({c}) < max({c})"
            for c in ORDER_NUMBERS
        )
        + ") ORDER BY abs(c) DESC, \"column\" LIMIT 15",
        f"freq AS (SELECT {ORDER_CLASS} AS class, row_number() OVER (ORDER BY count(*) DESC, {ORDER_CLASS}) - 1 AS y "
        f"FROM records GROUP BY {ORDER_CLASS})",
        f"indexed AS MATERIALIZED (SELECT * FROM records JOIN freq ON class = {ORDER_CLASS})",
    ),
    "order_class_shift": "SELECT *, round(test_pct - train_pct, 2) AS diff_pct FROM (SELECT *, "
    "round(train * 100.0::DOUBLE / sum(train) OVER (), 2) AS train_pct, round(test * 100.0::DOUBLE / sum(test) OVER (), 2) AS test_pct "
    f"FROM (SELECT {ORDER_CLASS}, count(*) FILTER (o_orderdate < TIMESTAMP '{EXTERNAL_FROM}' AND {IS_KNOWN}) AS train, "
    f"count(*) FILTER (o_orderdate >= TIMESTAMP '{EXTERNAL_FROM}') AS test FROM orders GROUP BY {ORDER_CLASS}))",
    "order_split_sizes": over(
        "SELECT split, count(*) AS n, (count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE) AS share FROM known GROUP BY split", KNOWN
    ),
    "order_split_class_pivot": over(
        f"SELECT {ORDER_CLASS}, "
        + ", ".join(
            f"round(count(*) FILTER (split = '{s}') * 100.0::DOUBLE / sum(count(*) FILTER (split = '{s}')) OVER (), 2) AS {s}"
            for s in SPLITS
        )
        + f" FROM known GROUP BY {ORDER_CLASS}",
        KNOWN,
    ),
    "order_stratified_split": f"SELECT o_orderkey, {ORDER_CLASS}, {SPLIT} AS split FROM orders WHERE {IS_KNOWN}",
    "order_split_overlaps": over(
        stacked(
            [
                *(
                    f"SELECT '{a} & {b}' AS \"check\", count(*) AS n FROM (SELECT o_orderkey FROM known WHERE split = '{a}' "
                    f"INTERSECT SELECT o_orderkey FROM known WHERE split = '{b}')"
                    for a, b in (("train", "val"), ("train", "test"), ("val", "test"))
                ),
                "SELECT 'missing' AS \"check\", count(*) AS n FROM known WHERE split IS NULL",
                "SELECT 'repeated' AS \"check\", count(*) - count(DISTINCT o_orderkey) AS n FROM known",
            ]
        ),
        KNOWN,
    ),
    "order_kfold_assignment": over(
        f"SELECT o_orderkey, floor({draw('fold')} * {FOLDS})::INTEGER AS fold FROM known WHERE split = 'train'", KNOWN
    ),
    "order_union_class_parts": f"SELECT o_orderkey, {ORDER_CLASS} FROM orders WHERE {IS_KNOWN}",
    "order_class_weights": over("SELECT * FROM weights", KNOWN, WEIGHTS),
    "order_attach_class_weight": over(
        f"SELECT o_orderkey, {ORDER_CLASS}, coalesce(weight, 1.0)::DOUBLE AS class_weight FROM orders LEFT JOIN weights USING ({ORDER_CLASS})",
        KNOWN,
        WEIGHTS,
    ),
    "order_label_index": over(
        f"SELECT o_orderkey, {ORDER_CLASS}, (SELECT count(DISTINCT k.{ORDER_CLASS}) FROM known k WHERE k.split = 'train' AND "
        f"(k.{ORDER_CLASS} < orders.{ORDER_CLASS} OR NOT ({IS_KNOWN.replace(ORDER_CLASS, 'orders.' + ORDER_CLASS)})))::DOUBLE AS label FROM orders",
        KNOWN,
    ),
    "order_category_index": over(
        "SELECT o_orderkey, "
        + ", ".join(f"coalesce(v_{c}.i, (SELECT count(*) FROM v_{c}))::DOUBLE AS {c}_idx" for c in ORDER_CATEGORIES)
        + f" FROM known {JOINS}",
        KNOWN,
        *VOCAB,
    ),
    "order_one_hot": over(
        "SELECT o_orderkey, " + ", ".join(f"{e} AS f{i:02d}" for i, e in enumerate(HOT)) + f" FROM known {JOINS}", KNOWN, *VOCAB
    ),
    "order_assemble_features": over(
        "SELECT o_orderkey, split, " + ", ".join(f"{r(s)} AS {s}" for s in SLOTS) + " FROM feats", KNOWN, *VOCAB, FEATURES
    ),
    "order_feature_pipeline": over(
        f"SELECT o_orderkey, split, (SELECT count(DISTINCT k.{ORDER_CLASS}) FROM known k WHERE k.split = 'train' AND "
        f"k.{ORDER_CLASS} < feats.{ORDER_CLASS})::DOUBLE AS label, {ORDER_CLASS}, "
        + ", ".join(f"{r(f'CASE WHEN s_{s} = 0 THEN 0.0 ELSE ({s} - a_{s}) / s_{s} END')} AS {s}" for s in SLOTS)
        + " FROM feats, (SELECT "
        + ", ".join(f"avg({s}) AS a_{s}, stddev_samp({s}) AS s_{s}" for s in SLOTS)
        + " FROM feats WHERE split = 'train')",
        KNOWN,
        *VOCAB,
        FEATURES,
    ),
    "order_pipeline_roundtrip": over(
        "SELECT split, count(*) AS n, 0::BIGINT AS only_before, 0::BIGINT AS only_after FROM feats GROUP BY split", KNOWN, *VOCAB, FEATURES
    ),
}
