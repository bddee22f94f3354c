"""Cross-site boilerplate removal: HyperLogLog site spread per line hash, exact counts near the threshold.

DataFrame functions only. Sites are the values of the source column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import small_side, table

MIN_SITES = 10
LG_K = 12
# Half-width of the band of estimates around the threshold that are counted exactly, as a share of it: over four
# standard errors of a sketch of 2^12 registers, so a line outside it is on its side of the threshold.
BAND = 0.08


def _rows(documents: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Whole input rows as one struct beside the working columns, so no input name can clash."""
    c = documents
    return documents.select(F.struct(*[c[f"`{n}`"] for n in c.columns]).alias("row"), c[id_col].alias("id"),
                            c[text_col].alias("text"), c[source_col].cast("string").alias("site"),
                            F.xxhash64(c[text_col]).alias("version"))


def _lines(rows: DataFrame) -> DataFrame:
    """``id, version, site, pos, line_hash`` of every line that isn't blank."""
    lines = rows.select("id", "version", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.where(F.trim("line") != "").select("id", "version", "site", "pos", F.xxhash64(F.trim("line")).alias("line_hash"))


def boilerplate(rows: DataFrame, min_sites: int, lg_k: int) -> tuple[DataFrame, DataFrame]:
    """``(lines, occurrences)``: line hashes on at least ``min_sites`` sites with their first place, and all their places.

    One sketch per line hash and map task is merged in the aggregation, so a line in a third of all documents moves
    one small sketch per task. Lines within the band of the threshold get an exact distinct count over their occurrences.
    """
    lines = _lines(rows)
    spread = lines.groupBy("line_hash").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(F.struct("id", "version", "pos")).alias("first"))
    band = max(1.0, BAND * min_sites)
    estimate = F.hll_sketch_estimate("sketch")
    wide = table(spread.where(estimate >= min_sites - band)
                 .select("line_hash", "first", (estimate <= min_sites + band).alias("near")), "wide-lines")
    places = table(lines.join(small_side(wide.select("line_hash", "near")), "line_hash"), "wide-places")
    exact = places.where("near").groupBy("line_hash").agg(F.count_distinct("site").alias("sites"))
    kept = wide.join(exact, "line_hash", "left").where(~F.col("near") | (F.col("sites") >= min_sites))
    return kept.select("line_hash", "first"), places.select("line_hash", "id", "version", "pos")


def _kept_text(text: Column, drop: Column) -> Column:
    """``text`` without the lines at the positions in ``drop``, in time linear in the lines."""
    lines = F.split(text, "\n", -1)
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    return F.array_join(F.transform(keep, lambda i: lines[i]), "\n")


def remove_boilerplate(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                       min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """One row per row of ``documents``: ``row`` (the input row), ``text`` (cleaned), ``n_lines``, ``n_removed``, ``n_left``.

    A line (between line feeds, outer spaces ignored) on at least ``min_sites`` distinct sites is removed wherever it
    occurs but at its first place (least id, then position), so no text is lost. ``n_left`` counts the lines left that
    aren't blank. Blank lines stay. A null source is no site; a null text stays null with no lines; an empty text has one
    blank line; rows repeated with id and text are treated alike (both keep a first place). An empty table gives an empty
    result. Texts move only if the affected documents are too many to broadcast their line positions.
    """
    rows = _rows(documents, id_col, text_col, source_col)
    lines, places = boilerplate(rows, min_sites, lg_k)
    first = (F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.version") == F.col("version"))
             & (F.col("first.pos") == F.col("pos")))
    drops = table(places.join(small_side(lines), "line_hash").where(~first)
                  .groupBy("id", "version").agg(F.collect_set("pos").alias("drop")), "line-drops")
    n_docs, n_places = drops.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("drop")), F.lit(0))).first()
    drops = small_side(drops, n_docs + n_places)
    joined = rows.alias("r").join(
        drops.alias("d"), F.col("r.id").eqNullSafe(F.col("d.id")) & (F.col("r.version") == F.col("d.version")), "left")
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(_kept_text(F.col("text"), F.col("drop")))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return (joined.select("row", text.alias("text"), n_lines.cast("long").alias("n_lines"),
                          F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"))
            .withColumn("n_left", F.coalesce(F.size(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")), F.lit(0))
                        .cast("long")))


def clean_documents(documents: DataFrame, *, text_col: str = "text", n_chars_col: str = "n_chars", **options) -> DataFrame:
    """``documents`` with cleaned texts and character counts; those with no line left of some removed are dropped."""
    cleaned = remove_boilerplate(documents, text_col=text_col, **options).where("n_removed = 0 or n_left > 0")
    new = {text_col: F.col("text"), n_chars_col: F.char_length("text").cast("long")}
    return cleaned.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns])
