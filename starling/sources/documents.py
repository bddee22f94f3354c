"""Nested order documents assembled from flat tables, as a Spark job.

Mapping from the driver tables to the document shape:
order_id = o_orderkey; customer = {o_custkey, c_mktsegment, tier band of
c_acctbal}; order_date = o_orderdate as 'yyyy-MM-dd HH:mm:ss'; status =
o_orderstatus; payment = {o_orderpriority, 'EUR', o_totalprice}; items =
lineitem x part {l_partkey, p_type, l_quantity, p_retailprice}, in line order;
shipping = {n_name, r_name, delivery type from o_orderpriority}.

Documents are grouped into array files of bounded size: a file holds the
orders of one order month within one span of ``FILE_KEY_SPAN`` order keys, so
no file (and no group) can exceed that many documents at any scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_KEY_SPAN = 100_000

# Loyalty bands by account balance: the upper bounds of all but the last, lowest first.
BANDS = {"IN_DEBT": 0, "LOW": 3000, "MIDDLE": 7000}
TOP_BAND = "HIGH"
CURRENCY = "EUR"

TABLES = ("orders", "lineitem", "part", "customer", "nation", "region")


@dataclass
class Tables:
    orders: DataFrame
    lineitem: DataFrame
    part: DataFrame
    customer: DataFrame
    nation: DataFrame
    region: DataFrame


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(**{t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES})


def tier_of(acctbal: Column) -> Column:
    """Loyalty band of an account balance."""
    out = F
    for name, bound in BANDS.items():
        out = out.when(acctbal < bound, name)
    return out.otherwise(TOP_BAND)


def promote(tier: Column) -> Column:
    """The next band up; the top one stays."""
    names = [*BANDS, TOP_BAND]
    out = F
    for name, above in zip(names, names[1:]):
        out = out.when(tier == name, above)
    return out.otherwise(tier)


def delivery_type(priority: Column) -> Column:
    return (F.when(priority.isin("1-URGENT", "2-HIGH"), "EXPRESS")
            .when(priority == "5-LOW", "FREIGHT").otherwise("STANDARD"))


def file_name_of(order_date: Column, order_key: Column, prefix: str | Column = "") -> Column:
    chunk = F.format_string("%05d", F.floor(order_key / F.lit(FILE_KEY_SPAN)).cast("bigint"))     # never cut
    start = F.lit(f"{prefix}orders_") if isinstance(prefix, str) else F.concat(prefix, F.lit("orders_"))
    return F.concat(start, F.date_format(order_date, "yyyyMM"), F.lit("_"), chunk, F.lit(".json"))


def order_documents(t: Tables, *, orders_where: Column | None = None, lines_where: Column | None = None,
                    status: Column | None = None, promote_tier: bool | Column = False,
                    file_prefix: str | Column = "") -> DataFrame:
    """One row per order: ``(order_id, file_name, doc, priority, order_status)`` with ``doc`` the JSON text.

    ``orders_where`` picks the orders sent, ``lines_where`` the line items kept in
    them, ``status`` overrides the status, ``promote_tier`` moves each
    customer's tier up one step (re-sent documents after a promotion; a column tells for which orders).
    """
    li = t.lineitem if lines_where is None else t.lineitem.where(lines_where)
    return _documents(t, li, [Version(file_prefix, None, status, promote_tier)], orders_where)


@dataclass(frozen=True)
class Version:
    """What a document of an order has: the file's prefix, the line items (all, or those where ``lines_where`` holds), another
    status, a tier one step up (a column tells for which orders)."""
    file_prefix: str | Column = ""
    lines_where: Column | None = None
    status: Column | None = None
    promote_tier: bool | Column = False


def order_versions(t: Tables, versions: list[Version]) -> DataFrame:
    """One row per order and version, as ``order_documents`` of each version would give them; one pass over the tables."""
    return _documents(t, t.lineitem, versions)


def _documents(t: Tables, li: DataFrame, versions: list[Version], orders_where: Column | None = None) -> DataFrame:
    o = t.orders if orders_where is None else t.orders.where(orders_where)
    kept = {k: F.coalesce(v.lines_where, F.lit(False)).alias(f"in_{k}") for k, v in enumerate(versions) if v.lines_where is not None}
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", *kept.values())
    if orders_where is not None:
        # lines of the selected orders only; the semi join shuffles on l_orderkey, which the
        # grouping below and the join to orders reuse, so it adds no exchange
        li = li.join(o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    items = (li
             .join(t.part.select("p_partkey", "p_type", "p_retailprice"),
                   F.col("l_partkey") == F.col("p_partkey"), "left")
             .groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("l_linenumber").alias("n"),
                 F.col("l_partkey").alias("product_id"),
                 F.col("p_type").alias("category"),
                 F.col("l_quantity").cast("bigint").alias("quantity"),
                 F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
                 *[f"in_{k}" for k in kept]))).alias("lines")))
    geo = (t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
           .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    base = (o.join(geo, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left"))

    def lines_of(k: int) -> Column:
        return F.filter("lines", lambda x: x[f"in_{k}"]) if k in kept else F.col("lines")

    rows = [F.struct(file_name_of(F.col("o_orderdate"), F.col("o_orderkey"), v.file_prefix).alias("file_name"),
                     _document(v, lines_of(k)).alias("doc")) for k, v in enumerate(versions)]
    order = [F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("order_status")]
    if len(rows) == 1:
        base = base.select(*order, rows[0].alias("v"))
    else:
        base = base.select(*order, F.explode(F.array(*rows)).alias("v"))
    return base.select("order_id", "v.file_name", "v.doc", "priority", "order_status")


def _document(v: Version, lines: Column) -> Column:
    tier = tier_of(F.col("c_acctbal"))
    if not isinstance(v.promote_tier, bool):
        tier = F.when(v.promote_tier, promote(tier)).otherwise(tier)
    elif v.promote_tier:
        tier = promote(tier)
    line_fields = ["product_id", "category", "quantity", "unit_price"]
    return F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.struct(F.col("o_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"),
                 tier.alias("loyalty_tier")).alias("customer"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        (F.col("o_orderstatus") if v.status is None else v.status).alias("status"),
        F.struct(F.col("o_orderpriority").alias("method"), F.lit(CURRENCY).alias("currency"),
                 F.col("o_totalprice").cast("decimal(18,2)").alias("amount")).alias("payment"),
        F.coalesce(F.transform(lines, lambda x: F.struct(*[x[f].alias(f) for f in line_fields])),
                   F.array()).alias("items"),
        F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("city"),
                 delivery_type(F.col("o_orderpriority")).alias("delivery_type")).alias("shipping")))


def documents_to_files(docs: DataFrame) -> DataFrame:
    """Group documents into one JSON array text per file, documents in key order.

    Each group is bounded by the file rule (one date, one key span)."""
    return docs.groupBy("file_name").agg(_in_key_order().alias("_d")).select("file_name", _array_text("_d").alias("value"))


def documents_to_mixed_files(docs: DataFrame) -> DataFrame:
    """``documents_to_files`` by the documents' ``kind``: ``array`` one array, ``lines`` one object per line, ``twice`` two arrays in
    a file. A file that holds several kinds (that of the orders without a date) has one after the other."""
    def of(kind: str) -> Column:
        there = F.filter("_d", lambda x: x["kind"] == kind)
        return F.when(F.size(there) > 0, there)

    array, twice = _array_text(of("array")), _array_text(of("twice"))
    value = F.concat_ws("\n", array, F.array_join(_texts(of("lines")), "\n"), twice, twice)
    return docs.groupBy("file_name").agg(_in_key_order("kind").alias("_d")).select("file_name", value.alias("value"))


def _in_key_order(*more: str) -> Column:
    return F.sort_array(F.collect_list(F.struct("order_id", "doc", *more)))


def _texts(docs: Column | str) -> Column:
    return F.transform(docs, lambda x: x["doc"])


def _array_text(docs: Column | str) -> Column:
    return F.concat(F.lit("["), F.array_join(_texts(docs), ","), F.lit("]"))
