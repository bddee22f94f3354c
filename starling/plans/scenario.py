"""Order-document batches derived from the driver's flat tables.

* batch 1, initial load: every order, as it is.
* batch 2, status update: every open order (``o_orderstatus = 'O'``) is sent
  again as fulfilled ('F'), keeping only its fulfilled lines
  (``l_linestatus = 'F'``), with its customer promoted one loyalty tier. Open
  orders whose lines are all open come back with ``items: []`` (D8).
* dated batches: the initial load cut by order date into four consecutive
  loads, followed by the status update (incremental == one-batch check).

Load times are derived constants (one per batch), never the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.sources.documents import Tables, documents_to_files, load_tables, order_documents
from starling.sources.json_files import landing_rows

LOAD_BASE = "2030-06-15 00:00:00"
DATE_CUTS = ["1997-01-01", "1999-01-01", "2001-01-01"]


def load_ts_of(batch: int) -> Column:
    return F.to_timestamp(F.lit(LOAD_BASE)) + F.make_dt_interval(hours=F.lit(batch - 1))


def initial_documents(t: Tables, orders_where: Column | None = None, prefix: str = "b1/") -> DataFrame:
    return order_documents(t, orders_where=orders_where, file_prefix=prefix)


def resend_documents(t: Tables, prefix: str = "b2/") -> DataFrame:
    return order_documents(t, orders_where=F.col("o_orderstatus") == "O",
                           lines_where=F.col("l_linestatus") == "F",
                           status=F.lit("F"), promote_tier=True, file_prefix=prefix)


def with_text_amount(docs: DataFrame, where: Column, text: str = "n/a") -> DataFrame:
    """Documents where ``where`` holds get ``payment.amount`` as a text value that does not cast
    (a bad upstream value; permissive loads route such documents to rejects, D10)."""
    bad = F.regexp_replace(F.col("doc"), r'"amount":-?[0-9.Ee+-]+', f'"amount":"{text}"')
    return docs.withColumn("doc", F.when(where, bad).otherwise(F.col("doc")))


def landing_of(docs: DataFrame, batch: int) -> DataFrame:
    """Documents -> array files -> parsed landing rows, as a load would produce."""
    return landing_rows(documents_to_files(docs), load_ts=load_ts_of(batch))


def two_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    t = load_tables(spark, sf_dir)
    return [landing_of(initial_documents(t), 1), landing_of(resend_documents(t), 2)]


def dated_document_batches(t: Tables) -> list[DataFrame]:
    d = F.col("o_orderdate")
    bounds = [None, *DATE_CUTS, None]
    out = []
    for i in range(len(bounds) - 1):
        lo, hi = bounds[i], bounds[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            cond = cond & (d < F.lit(hi).cast("timestamp_ntz"))
        if lo is None:
            cond = cond | d.isNull()        # an order without a date comes with the first load
        out.append(initial_documents(t, orders_where=cond, prefix=f"d{i + 1}/"))
    out.append(resend_documents(t, prefix=f"d{len(bounds)}/"))
    return out


def dated_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    t = load_tables(spark, sf_dir)
    return [landing_of(docs, i + 1) for i, docs in enumerate(dated_document_batches(t))]
