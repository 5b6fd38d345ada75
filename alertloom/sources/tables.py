"""Inputs: Parquet tables, the positional record format, and the views built on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from alertloom.functions.expressions import attack_category, hash_draw, label_name
from alertloom.params import LABEL_COL, RAW_COLUMNS
from alertloom.session import small_methods, spread

RAW_SCHEMA = ", ".join(f"`{name}` {dtype}" for name, dtype in RAW_COLUMNS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_records(spark: SparkSession, path: str, schema: str | StructType | DataType = RAW_SCHEMA) -> DataFrame:
    """Headerless CSV with columns named by position.

    The pinned schema saves the inference pass over the file and keeps the types
    of separate files equal.
    """
    return spark.read.schema(schema).csv(path, header=False)


def read_labelled_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw records with their attack category."""
    return with_category(read_records(spark, path))


def with_category(records: DataFrame) -> DataFrame:
    return records.withColumn(LABEL_COL, attack_category("attack_type"))


# --- views over the test tables ---------------------------------------------

EVENT_CLASS = {"click": 0, "view": 1, "error": 2, "signup": 3, "purchase": 4}
ALERT_STREAMS = 16


def alerts_from_events(events: DataFrame) -> DataFrame:
    """Scored alerts: true class, predicted class and its probability, per stream and time.

    A row-local projection, so it works on batch and streaming input alike.
    """
    true_class = F.when(hash_draw("event_id", "n") < 0.55, 1)
    for name, index in EVENT_CLASS.items():
        true_class = true_class.when(F.col("event_type") == name, index)
    shifted = ((F.col("true_class") + 1 + F.floor(hash_draw("event_id", "q") * 4)) % 5).cast("int")
    return (
        events.withColumn("true_class", true_class.cast("int"))
        .withColumn(
            "predicted_class",
            F.when(hash_draw("event_id", "p") < 0.88, F.col("true_class")).otherwise(shifted),
        )
        .select(
            F.col("event_id").alias("alert_id"),
            (F.col("user_id") % ALERT_STREAMS).alias("stream_id"),
            "ts",
            "true_class",
            label_name("true_class").alias("true_label"),
            "predicted_class",
            label_name("predicted_class").alias("predicted_label"),
            (F.lit(0.4) + F.lit(0.6) * hash_draw("event_id", "c")).alias("predicted_proba"),
            F.col("value").alias("error"),
        )
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_from_events(read_table(spark, sf_dir, "events"))


# One rule per raw column over {u}, a number in 0..65535 drawn from the event id,
# and y, the class of the event. Plain SQL arithmetic.
RECORD_RULES = {
    "duration": "{u} % 600 + 40 * y",
    "protocol_type": "CASE WHEN {u} % 10 < 6 THEN 'tcp' WHEN {u} % 10 < 9 THEN 'udp' ELSE 'icmp' END",
    "service": "CASE WHEN late >= 0.97 THEN 'late_svc' WHEN {u} % 16 < 6 THEN 'http' "
    "WHEN {u} % 16 < 9 THEN 'smtp' WHEN {u} % 16 < 11 THEN 'domain' WHEN {u} % 16 < 13 THEN 'ftp' "
    "WHEN {u} % 16 < 14 THEN 'telnet' WHEN {u} % 16 < 15 THEN 'ssh' ELSE 'other' END",
    "flag": "CASE WHEN {u} % 20 < 12 THEN 'SF' WHEN {u} % 20 < 16 THEN 'S0' "
    "WHEN {u} % 20 < 19 THEN 'REJ' ELSE 'RSTR' END",
    "src_bytes": "CASE WHEN {u} % 100 = 0 THEN NULL ELSE {u} % 9000 + 700 * y END",
    "dst_bytes": "{u} * 3 + 1000 * (4 - y)",
    "wrong_fragment": "{u} % 4",
    "urgent": "CASE WHEN {u} % 50 = 0 THEN 1 ELSE 0 END",
    "num_outbound_cmds": "0",
    "count": "{u} % 256 + 60 * y",
    "srv_count": "{u} % 256",
    "dst_host_count": "{u} % 256",
    "dst_host_srv_count": "{u} % 256",
    "serror_rate": "({u} % 41 + 15 * y) / 100.0",
    "same_srv_rate": "CASE WHEN {u} % 50 = 1 THEN NULL ELSE ({u} % 101) / 100.0 END",
    "attack_type": "CASE WHEN {u} % 64 = 0 THEN 'mystery_a' WHEN {u} % 64 = 1 THEN 'mystery_b' "
    "WHEN y = 1 THEN 'normal' "
    "WHEN y = 0 AND {u} % 3 = 0 THEN 'back' WHEN y = 0 AND {u} % 3 = 1 THEN 'smurf' WHEN y = 0 THEN 'neptune' "
    "WHEN y = 2 AND {u} % 2 = 0 THEN 'nmap' WHEN y = 2 THEN 'satan' "
    "WHEN y = 3 AND {u} % 2 = 0 THEN 'imap' WHEN y = 3 THEN 'phf' "
    "WHEN {u} % 2 = 0 THEN 'perl' ELSE 'xterm' END",
    "difficulty": "{u} % 22",
}
#: Events that one task makes records of, about.
RECORD_TASK_ROWS = 50_000
BINARY_COLUMNS = ("land", "logged_in", "root_shell", "su_attempted", "is_host_login", "is_guest_login")


def record_rule(name: str) -> str:
    if name in RECORD_RULES:
        return RECORD_RULES[name]
    if name in BINARY_COLUMNS:
        return "{u} % 2"
    if dict(RAW_COLUMNS)[name] == "double":
        return "({u} % 101) / 100.0"
    return "{u} % 8"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection records in the raw 43-column layout, plus their key ``record_id``, from ``events``."""
    small_methods(spark)
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    # filters on a record's columns stay above the generator: below the shuffle they would compute them in the scan's few tasks
    events = spread(events, "event_id", task_rows=RECORD_TASK_ROWS).select(F.inline(F.array(F.struct("event_id", "event_type"))))
    y = F.when(hash_draw("event_id", "n") < 0.55, 1)
    for name, index in EVENT_CLASS.items():
        y = y.when(F.col("event_type") == name, index)
    n_digests = (len(RAW_COLUMNS) + 7) // 8
    base = events.select(
        F.col("event_id").alias("record_id"),
        y.alias("y"),
        hash_draw("event_id", "split").alias("late"),
        *[F.md5(F.expr(f"concat(cast(event_id as string), ':f{j}')")).alias(f"m{j}") for j in range(n_digests)],
    )
    # each conversion of 8 hex digits yields the numbers of two columns
    n_words = (len(RAW_COLUMNS) + 1) // 2
    words = [
        F.conv(F.substring(f"m{w // 4}", 8 * (w % 4) + 1, 8), 16, 10).cast("bigint").alias(f"w{w}") for w in range(n_words)
    ]
    numbered = base.select("record_id", "y", "late", *words)
    columns = []
    for i, (name, dtype) in enumerate(RAW_COLUMNS):
        u = f"(w{i // 2} div 65536)" if i % 2 == 0 else f"(w{i // 2} % 65536)"
        columns.append(F.expr(f"cast({record_rule(name).format(u=u)} as {dtype})").alias(name))
    return numbered.select("record_id", *columns)


def labelled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_category(records(spark, sf_dir))


ORDER_CLASS = "o_orderpriority"
ORDER_CLASSES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")  # "4-NOT SPECIFIED" is no class
ORDER_CATEGORIES = ("o_orderstatus", "c_mktsegment", "r_name")
ORDER_NUMBERS = (
    "o_totalprice", "c_acctbal", "n_lines", "quantity", "revenue", "discount", "tax", "n_parts", "part_size", "retail", "ship_days"
)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per order: its class, categories and numbers from all the tables around it.

    Lines meet their part and are summed up per order before they meet the orders; an order without
    lines keeps null in what is summed (``n_lines`` is 0), one without its customer in what that has.
    Money and shares are summed as whole cents and percents, so that no order of the rows changes a sum.
    """

    def cents(column: str):
        return F.round(F.col(column) * 100).cast("bigint")

    lines = read_table(spark, sf_dir, "lineitem").join(
        read_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    per_order = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n"),
        F.sum("l_quantity").alias("quantity"),
        (F.sum(cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))) / 10_000.0).alias("revenue"),
        (F.sum(cents("l_discount")) / (F.count("l_discount") * 100.0)).alias("discount"),
        (F.sum(cents("l_tax")) / (F.count("l_tax") * 100.0)).alias("tax"),
        F.count("p_partkey").alias("n_parts"),
        (F.sum("p_size") / F.count("p_size")).alias("part_size"),
        (F.sum(cents("p_retailprice")) / 100.0).alias("retail"),
        F.max("l_shipdate").alias("shipped"),
    )
    place = read_table(spark, sf_dir, "nation").join(
        read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = read_table(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    orders = read_table(spark, sf_dir, "orders")
    return (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .withColumn("n_lines", F.coalesce("n", F.lit(0)))
        .withColumn("ship_days", F.datediff("shipped", "o_orderdate"))
        .select("o_orderkey", "o_orderdate", ORDER_CLASS, *ORDER_CATEGORIES, *ORDER_NUMBERS)
    )
