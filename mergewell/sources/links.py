"""Known links between records: read from lists in cells or from wide rows, as distinct pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import stripped

#: Ids that mean none, in any case.
NONE = ["nan", "none", "null"]


def _known(c: Column) -> Column:
    return (c != "") & ~F.lower(c).isin(NONE)


def cell_ids(c: Column) -> Column:
    """Ids of a cell, which , ; or | separate."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[,;|]"), stripped), _known)


def header(df: DataFrame) -> tuple[str, str]:
    """The names that results carry: those of the first two columns, or the usual ones where there is only one."""
    return (df.columns[0], df.columns[1]) if len(df.columns) > 1 else ("source1_id", "matched_id")


def link_lists(df: DataFrame) -> DataFrame:
    """(s1_id, target_ids) of every row with an id: two columns hold a list, three or more an id each, one holds none."""
    first, *rest = [df[f"`{c}`"] for c in df.columns]
    if not rest:
        ids = F.array().cast("array<string>")
    elif len(rest) == 1:
        ids = cell_ids(rest[0])
    else:
        ids = F.filter(F.array(*[stripped(c) for c in rest]), _known)
    return df.select(stripped(first).alias("s1_id"), ids.alias("target_ids")).where(F.col("s1_id") != "")


def link_pairs(df: DataFrame) -> DataFrame:
    """Distinct (s1_id, target_id)."""
    return link_lists(df).select("s1_id", F.explode("target_ids").alias("target_id")).distinct()


def link_sets(df: DataFrame) -> DataFrame:
    """(s1_id, target_ids) with sorted distinct ids; an id without links has an empty list."""
    rows = link_lists(df).select("s1_id", F.explode_outer("target_ids").alias("target_id"))
    return rows.groupBy("s1_id").agg(F.sort_array(F.collect_set("target_id")).alias("target_ids"))
