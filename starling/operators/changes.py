"""Change rows between two versions of a table.

``net_changes`` (keyed, I2) returns what a change stream shows: an INSERT
image for a new key, a DELETE image for a removed key, and DELETE + INSERT
images with ``_is_update = true`` for a key whose values changed. Both versions
meet in one aggregation by key (``upsert.met_by_key``); the images are generated per key.

``multiset_changes`` (keyless, I3) is the multiset difference both ways
(``EXCEPT ALL``) in one aggregation, for tables like order items that have no key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.operators.upsert import met_by_key

ACTION = "_action"
IS_UPDATE = "_is_update"


def net_changes(before: DataFrame, after: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    cols = cols or [c for c in after.columns if c not in keys]
    j = met_by_key(before.select(*keys, *cols), after.select(*keys, *cols), keys)
    in_b, in_a = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    same = F.lit(True)
    for c in cols:
        same = same & F.col("_l").getField(c).eqNullSafe(F.col("_r").getField(c))
    changed = in_a & in_b & ~same

    def image(side: str, action: str, other: Column) -> Column:
        return F.struct(*[F.col(side).getField(c).alias(c) for c in cols], F.lit(action).alias(ACTION), other.alias(IS_UPDATE))

    del_img, ins_img = image("_l", "DELETE", in_a), image("_r", "INSERT", in_b)
    images = F.array(F.when(in_b & (~in_a | changed), del_img), F.when(in_a & (~in_b | changed), ins_img))
    out = j.select(*keys, F.explode(F.filter(images, lambda x: x.isNotNull())).alias("_img"))
    return out.select(*keys, *[F.col(f"_img.{c}").alias(c) for c in cols],
                      F.col(f"_img.{ACTION}").alias(ACTION), F.col(f"_img.{IS_UPDATE}").alias(IS_UPDATE))


def multiset_changes(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Both multiset differences in one aggregation: copies after less copies before, repeated by their number."""
    cols = cols or after.columns
    both = (before.select(*cols, F.lit(-1).alias("_n")).unionByName(after.select(*cols, F.lit(1).alias("_n"))))
    net = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    action = F.when(F.col("_n") < 0, "DELETE").otherwise("INSERT")
    return net.select(*cols, action.alias(ACTION), F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int"))).alias("_copy")).drop("_copy")
