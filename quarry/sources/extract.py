"""Feature extraction queries (S9) over the star-schema tables.

The original runs these steps as SQL scripts that are not part of it; only
their output shapes are known: a comma record ``key, flag, flag, label`` for
q05, an all-numeric vector per line for q20/q25/q26 and ``id, label, text``
for q28. The queries below are our own and return DataFrames with those
shapes directly, so no text files sit between extraction and model fitting.

Plan notes, for fact tables at cluster scale:

* ``lineitem`` is reduced to one row per order (a partial + final hash
  aggregate on ``l_orderkey``) before it meets ``orders``. The aggregate's
  output is already hash-partitioned by order key, so the join with
  ``orders`` shuffles only the ``orders`` side, and a hot order key is
  collapsed map-side before any shuffle.
* Per-customer sums are again partial aggregates, so a customer holding a
  third of all orders costs one row per map task in the shuffle.
* Dimension joins (``part``) are left to Catalyst/AQE: they become broadcast
  joins only when the measured size is under
  ``spark.sql.autoBroadcastJoinThreshold``, else sort-merge with AQE skew
  splitting.
* Global constants (the last order date, the overall category share) are
  scalar subqueries, evaluated once and inlined; no single-partition window
  and no cross join. A subquery reads either one column of a table (q25) or
  a materialized customer-sized table (q05), never a second fact-table join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import fixed

from ..session import materialize
from . import prune
from .tables import table

# Fixed values of our extraction queries (not taken from the original).
Q05_CATEGORY = "ECONOMY"                       # product type whose interest is predicted
Q05_BALANCE_LIMIT = 5000.0                     # c_acctbal above this -> first flag
Q05_SEGMENTS = ("AUTOMOBILE", "MACHINERY")     # c_mktsegment in these -> second flag
Q26_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
Q28_LABELS = ("NEG", "NEU", "POS")
Q28_TRAIN_BUCKETS = 8                          # doc_id % 10 < 8 -> train, else test


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                 "l_extendedprice", "l_returnflag")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")


def _cents(x):
    """Money with 2 decimals as exact integer cents (sums no longer depend on order)."""
    return F.round(x * F.lit(100.0)).cast("bigint")


def q20_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return behaviour per customer: share of orders with a return, share of
    returned quantity, share of returned money, and the number of returned lines.
    Money is summed in integer cents, so every ratio is exact before rounding."""
    returned = F.col("l_returnflag") == "R"
    per_order = (
        _order_lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(
            F.count_if(returned).alias("ret_lines"),
            F.sum("l_quantity").alias("qty"),
            F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)).alias("ret_qty"),
            F.sum(_cents(F.col("l_extendedprice"))).alias("amt"),
            F.sum(F.when(returned, _cents(F.col("l_extendedprice"))).otherwise(F.lit(0).cast("bigint")))
            .alias("ret_amt"),
        )
    )
    per_customer = (
        per_order.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("n_orders"),
            F.count_if(F.col("ret_lines") > 0).alias("n_ret_orders"),
            F.sum("qty").alias("qty"),
            F.sum("ret_qty").alias("ret_qty"),
            F.sum("amt").alias("amt"),
            F.sum("ret_amt").alias("ret_amt"),
            F.sum("ret_lines").alias("ret_lines"),
        )
    )
    return per_customer.select(
        "c_custkey",
        fixed(F.col("n_ret_orders") / F.col("n_orders"), 6).alias("order_ratio"),
        fixed(F.col("ret_qty") / F.col("qty"), 6).alias("item_ratio"),
        fixed(F.col("ret_amt").cast("double") / F.col("amt").cast("double"), 6).alias("amount_ratio"),
        F.col("ret_lines").cast("double").alias("returns"),
    )


def q25_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency, frequency and money per customer: days from the customer's
    last order to the last order overall, number of orders, and total order
    value in thousands (summed exactly in cents)."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    last_overall = orders.select(F.max("o_orderdate")).scalar()
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("last_order"),
        F.count("*").alias("n_orders"),
        F.sum(_cents(F.col("o_totalprice"))).alias("amount_cents"),
    )
    return per_customer.select(
        "c_custkey",
        F.datediff(last_overall.cast("date"), F.col("last_order").cast("date"))
        .cast("double").alias("recency"),
        F.col("n_orders").cast("double").alias("frequency"),
        fixed(F.col("amount_cents").cast("double") / 100000.0, 3).alias("monetary"),
    )


def q26_features(spark: SparkSession, sf_dir: str, types=Q26_TYPES) -> DataFrame:
    """Purchased lines per product type and customer, one column per type, and ``n_other``
    for lines of any other type (or of a part without one): no line is lost unseen."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    typed = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    per_order = typed.groupBy("l_orderkey").agg(
        *[F.count_if(F.col("p_type") == t).alias(f"n_{t.lower()}") for t in types],
        F.count_if(~F.coalesce(F.col("p_type").isin(*types), F.lit(False))).alias("n_other"),
    )
    counts = [*[f"n_{t.lower()}" for t in types], "n_other"]
    per_customer = (
        per_order.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(*[F.sum(c).cast("double").alias(c) for c in counts])
    )
    return per_customer


def q05_features(spark: SparkSession, sf_dir: str, category: str = Q05_CATEGORY) -> DataFrame:
    """Two 0/1 customer flags and a 0/1 label: whether the customer's share of
    purchased lines in ``category`` is above the share over all customers' lines.

    The per-customer counts are materialized once, so the global totals (a
    scalar subquery) read that customer-sized table instead of scanning and
    joining ``lineitem`` a second time. The comparison is done in integers
    (``e * L > E * l``) so it is exact.
    """
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    per_order = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("lines"), F.count_if(F.col("p_type") == category).alias("cat_lines"))
    )
    per_customer = materialize(
        per_order.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("lines").alias("lines"), F.sum("cat_lines").alias("cat_lines")))
    totals = per_customer.agg(F.struct(F.sum("lines").alias("all_lines"),
                                       F.sum("cat_lines").alias("all_cat"))).scalar()
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    joined = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_custkey").alias("c_customer_sk"),
        (F.col("c_acctbal") > Q05_BALANCE_LIMIT).cast("double").alias("flag_balance"),
        F.col("c_mktsegment").isin(*Q05_SEGMENTS).cast("double").alias("flag_segment"),
        (F.col("cat_lines").cast("decimal(19,0)") * totals["all_lines"].cast("decimal(19,0)")
         > totals["all_cat"].cast("decimal(19,0)") * F.col("lines").cast("decimal(19,0)"))
        .cast("double").alias("label"),
    )


EMBEDDING_DIMS = 64


def embedding_features(spark: SparkSession, sf_dir: str, dims: int = EMBEDDING_DIMS) -> DataFrame:
    """The ``embeddings`` vectors as ``vec_id, x0 .. x{dims-1}`` double columns:
    an all-numeric vector per row, the k-means input shape. A vector of another width fails the
    job, as it does in the space reader; a null one has null columns, which count as unplaced."""
    vectors = of_width(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "embedding", dims)
    return vectors.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(dims)])


def of_width(df: DataFrame, column: str, dims: int) -> DataFrame:
    """``df``, which fails when a vector in ``column`` has not ``dims`` entries; null vectors pass."""
    vector = F.col(column)
    wrong = F.raise_error(F.concat(F.lit(f"a vector of {column} has not {dims} entries but "), F.size(vector).cast("string")))
    return df.withColumn(column, F.when(vector.isNull() | (F.size(vector) == dims), vector).otherwise(wrong))


def embedding_labels(spark: SparkSession, sf_dir: str, dims: int = EMBEDDING_DIMS) -> DataFrame:
    """``vec_id, features, label``: the vectors as double arrays, and 1 for the upper half of their ten labels, else 0."""
    vectors = of_width(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), "embedding", dims)
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                          (F.col("label") >= 5).cast("double").alias("label"))


def q28_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: NEG if toxic, else POS if of quality, else NEU;
    ``split`` is 'train' for ``doc_id % 10 < 8`` and 'test' otherwise. Texts without
    a label are left out where they are read (``prune``), so the join moves those with one only."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = prune.keep_possible(table(spark, sf_dir, "documents", "doc_id", "text"), labels, "doc_id")
    joined = docs.join(labels, "doc_id")
    label = (
        F.when(F.col("toxic") == 1, F.lit("NEG"))
        .when(F.col("quality") == 1, F.lit("POS"))
        .otherwise(F.lit("NEU"))
    )
    split = F.when(F.pmod(F.col("doc_id"), F.lit(10)) < Q28_TRAIN_BUCKETS, F.lit("train")).otherwise(F.lit("test"))
    return joined.select(F.col("doc_id"), label.alias("label"), F.col("text"), split.alias("split"))


def q28_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q28 extraction result: id, label, review text and split."""
    return q28_documents(spark, sf_dir)
