"""Stage tables in the shared folder, and numbering rows without a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reglink.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the session's shared checkpoint folder and read it
    back: later steps neither recompute it nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: str | None, order: list[Column], into: str, name: str) -> DataFrame:
    """Add ``into``: the row's place from 0, without gaps, inside its ``group``
    (or in all rows) under ``order``.

    Rows are dealt by range of (group, order, salt), so that neither one group
    nor one repeated key meets in one task; each range's groups are counted, and
    the counts before a range (a table of at most ranges + groups rows) give its
    first number.  The last sort key is a salt for equal rows: among rows equal
    in group and order the numbers are arbitrary.
    """
    keys = [F.col(group)] if group else []
    salt, part, base = "_salt", "_part", "_base"
    ranged = (df.withColumn(salt, F.monotonically_increasing_id())
              .repartitionByRange(*keys, *order, F.col(salt))
              .withColumn(part, F.spark_partition_id()))
    held = stage(ranged, name)
    by = [*([group] if group else []), part]
    sizes = held.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    if group:
        before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(base))
    place = Window.partitionBy(*by).orderBy(*order, salt)
    local = held.withColumn(into, F.row_number().over(place) - 1)
    on = [local[c].eqNullSafe(bases[c]) for c in by]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (local.join(bases, cond)
            .select(*[local[c] for c in df.columns], (local[into] + bases[base]).cast("long").alias(into)))


def free_name(stem: str, taken: list[str]) -> str:
    """A column name that ``taken`` doesn't hold, in any case of letters."""
    held = {c.lower() for c in taken}
    while stem.lower() in held:
        stem += "_"
    return stem
