"""Declared tables of the catalog: inserts by position and by name, store assignment, truncate."""

import pytest
from pyspark.sql import types as T

from starling.store.catalog import Catalog

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("qty", T.DecimalType(4, 0)), T.StructField("price", T.DecimalType(4, 0)),
                       T.StructField("name", T.StringType())])


@pytest.fixture()
def catalog(spark):
    c = Catalog(spark)
    c.create_or_replace("t", SCHEMA)
    yield c
    c.drop()


def rows(c):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in c.read("t").collect()), key=repr)


def test_position_and_name_differ_for_swapped_columns(spark, catalog):
    swapped = spark.sql("SELECT 1 AS id, 30 AS price, 2 AS qty, 'a' AS name")
    catalog.insert_positional("t", swapped)
    assert rows(catalog) == [("1", "30", "2", "a")]
    catalog.insert_by_name("t", swapped)
    assert rows(catalog) == [("1", "2", "30", "a"), ("1", "30", "2", "a")]
    catalog.insert_by_name("t", spark.sql("SELECT 'b' AS name, 7 AS id"))             # missing columns are NULL
    assert ("7", None, None, "b") in rows(catalog)
    catalog.insert_by_name("t", swapped, overwrite=True)
    assert rows(catalog) == [("1", "2", "30", "a")]


def test_values_that_do_not_fit_raise(spark, catalog):
    for bad in ("SELECT 1 AS id, 123456 AS qty, 1 AS price, 'x' AS name", "SELECT 5000000000 AS id, 1 AS qty, 1 AS price, 'x' AS name",
                "SELECT 'one' AS id, 1 AS qty, 1 AS price, 'x' AS name"):
        with pytest.raises(Exception):
            catalog.insert_by_name("t", spark.sql(bad))
    with pytest.raises(Exception):
        catalog.insert_positional("t", spark.sql("SELECT 1 AS id, 2 AS qty"))          # too few columns
    with pytest.raises(Exception):
        catalog.insert_by_name("t", spark.sql("SELECT 1 AS id, 2 AS other"))           # no such column
    assert rows(catalog) == []


def test_truncate_replace_and_literal_rows(spark, catalog):
    from decimal import Decimal

    catalog.append_values("t", [(1, Decimal(1), None, "a"), (2, None, Decimal(2), None)])
    assert len(rows(catalog)) == 2
    catalog.truncate("t")
    assert rows(catalog) == [] and catalog.read("t").columns == ["id", "qty", "price", "name"]
    catalog.append_values("t", [(1, None, None, "a")])
    catalog.create_or_replace("t", SCHEMA)
    assert rows(catalog) == []
