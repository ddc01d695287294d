"""The prepared register kept on shared storage and brought up to date by its changed cards only.

The tables are those of ``RegisterSide.save_bucketed`` with one more column, ``_load``: the load that wrote a row.
A refresh compares the register with the stored one by row digest (a bag: equal cards are counted) and appends

* the cards that are new or whose number of copies changed, and ``dead`` rows naming the digest and load of the
  stored ones that they replace or that are gone;
* index entries (variants, segments) of the names and fathers that the index does not know yet.

Index entries of values that no card holds any more stay: they only give candidates, and every candidate is joined
with the live cards.  A load counts once it is entered in the registry, so one that died half-way is never read, and of
two writers at once the second works its difference out again.  When the appended and dead rows pass a quarter of the
register, or after ``MAX_LOADS`` loads, or with another threshold, metric, method or set of columns, all is built anew in a fresh
folder; the folder that it replaces goes with the next load.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.operators.edit_join import METHOD, VARIANT, EditIndex, by_bucket, register_bucketed
from reglink.operators.person import RegisterSide
from reglink.operators.segments import SEG_LEN, SEG_NO, SEG_TXT
from reglink.session import join_side, stage_table
from reglink.sources import registry

LOADS = "_manifest"        # registry of loads; the last entry tells what counts
MAX_LOADS = 64
ROW, LOAD = "_row", "_load"
VALUE = "b"
SEGMENT = [SEG_LEN, SEG_NO, SEG_TXT]


def row_digest(cols: list[str]):
    """128 bits of a card's content; nulls are told from blanks and from each other's places."""
    return F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(cols)))))


class RegisterIndex:
    """``RegisterIndex(spark, path, ...).refresh(rows)`` gives a ``RegisterSide`` that reads the tables in place."""

    def __init__(self, spark: SparkSession, path: str, threshold: float, metric: str = "levenshtein", buckets: int | None = None):
        self.spark, self.path, self.threshold, self.metric = spark, path.rstrip("/"), threshold, metric
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def refresh(self, rows: DataFrame) -> RegisterSide:
        """Bring the stored register to the content of ``rows`` (as from ``prepare_register``) and open it."""
        cols = sorted(rows.columns)
        rows = rows.select(*cols).withColumn(ROW, row_digest(cols))
        while True:
            number, line = registry.latest(self.spark, f"{self.path}/{LOADS}")
            state = json.loads(line) if line else None
            layout = [[f.name, f.dataType.simpleString()] for f in rows.schema.fields]
            if state is None or [state["layout"], state["threshold"], state["metric"], state.get("method")] != [layout, self.threshold, self.metric, METHOD]:
                new = self._build(rows, layout, state)
            else:
                new = self._update(rows, state)
            if new is None:
                return self._open(state)
            if registry.add(self.spark, f"{self.path}/{LOADS}", number + 1, json.dumps(new)):
                for folder in (state or {}).get("gone", []):
                    registry.remove(self.spark, f"{self.path}/{folder}")
                return self._open(new)

    def _build(self, rows: DataFrame, layout: list, before: dict | None) -> dict:
        load = uuid.uuid4().hex[:16]
        state = {"folder": f"base-{load}", "loads": [load], "layout": layout, "threshold": self.threshold, "metric": self.metric, "method": METHOD, "buckets": self.buckets,
                 "ddl": {}, "changed": 0, "gone": [before["folder"]] if before else []}
        self._append(state, load, rows, None)
        state["rows"] = self._table(state, "rows").count()
        return state

    def _update(self, rows: DataFrame, state: dict) -> dict | None:
        """The state after appending what differs; None where nothing does."""
        held = self._live(state, "rows").groupBy(ROW, LOAD).agg(F.count(F.lit(1)).alias("_held"))
        now = rows.groupBy(ROW).agg(F.count(F.lit(1)).alias("_now"))
        changes = stage_table(held.join(now, ROW, "full_outer").where(~F.col("_held").eqNullSafe(F.col("_now"))), "register-changes")
        n = changes.agg(F.coalesce(F.sum(F.coalesce("_held", F.lit(0)) + F.coalesce("_now", F.lit(0))), F.lit(0)).alias("n")).first()["n"]
        if not n:
            return None
        changed = state["changed"] + n
        if changed * 4 > state["rows"] or len(state["loads"]) >= MAX_LOADS:
            return self._build(rows, state["layout"], state)
        load = uuid.uuid4().hex[:16]
        added = stage_table(rows.join(join_side(changes.where("_now IS NOT NULL").select(ROW), n), ROW, "left_semi"), "register-added")
        self._append(state, load, added, changes.where("_held IS NOT NULL").select(ROW, LOAD))
        total = state["rows"] + changes.agg(F.sum(F.coalesce("_now", F.lit(0)) - F.coalesce("_held", F.lit(0))).alias("n")).first()["n"]
        return state | {"loads": [*state["loads"], load], "changed": changed, "rows": total, "gone": []}

    def _append(self, state: dict, load: str, rows: DataFrame, dead: DataFrame | None) -> None:
        """Write cards, and the index entries of values that the counted loads don't hold, under ``load``."""
        self._write(state, "rows", rows, load)
        if dead is None:
            rows = self._table(state, "rows").drop(LOAD)        # the register's source is read once
        two_key = rows.where((F.length("r_name") > 0) & (F.length("r_father") > 0))
        self._write(state, "two_key", two_key, load)
        if dead is not None:
            self._write(state, "dead", dead.withColumnRenamed(LOAD, "_of"), load)
        for part, key in (("names", "r_name"), ("fathers", "r_father")):
            values = two_key.select(F.col(key).alias(VALUE)).distinct()
            if dead is not None:
                values = values.join(join_side(self._table(state, f"{part}/values")), VALUE, "left_anti")
            values = stage_table(values, "register-values")
            ix = EditIndex(values, self.threshold, VALUE, self.metric)
            self._write(state, f"{part}/values", ix.values, load)
            if ix.segments is not None:
                self._write(state, f"{part}/segments", ix.segments, load)
                self._write(state, f"{part}/variants", ix.variants, load)
                self._write(state, f"{part}/lengths", ix.lengths, load)

    KEYS = {"rows": ["r_name"], "two_key": ["r_name", "r_father"], "values": [VALUE], "segments": SEGMENT, "variants": [VARIANT]}

    def _place(self, state: dict, part: str) -> tuple[str, str, list[str]]:
        """Folder, table name and bucket keys (none: a plain folder) of a part."""
        folder = f"{self.path}/{state['folder']}/{part}"
        return folder, f"reglink_{hashlib.md5(folder.encode()).hexdigest()[:16]}", self.KEYS.get(part.split("/")[-1], [])

    def _write(self, state: dict, part: str, df: DataFrame, load: str) -> None:
        folder, table, keys = self._place(state, part)
        df = df.withColumn(LOAD, F.lit(load))
        state["ddl"].setdefault(part, df.schema.toDDL())
        if not keys:
            df.write.mode("append").parquet(folder)
            return
        df = by_bucket(df, state["buckets"], keys)
        if load == state["loads"][0]:
            df.write.format("parquet").bucketBy(state["buckets"], *keys).sortBy(*keys).option("path", folder).saveAsTable(table)
        else:
            df.select(*self._attach(state, part).columns).write.insertInto(table)

    def _attach(self, state: dict, part: str) -> DataFrame:
        folder, table, keys = self._place(state, part)
        if not keys:
            return self.spark.read.schema(state["ddl"][part]).parquet(folder)
        return register_bucketed(self.spark, table, folder, state["ddl"][part], state["buckets"], keys)

    def _table(self, state: dict, part: str) -> DataFrame:
        """Rows of the loads that count."""
        return self._attach(state, part).where(F.col(LOAD).isin(state["loads"]))

    def _live(self, state: dict, part: str) -> DataFrame:
        """Cards that no later load replaced."""
        cards = self._table(state, part)
        if len(state["loads"]) == 1:
            return cards
        dead = self._table(state, "dead").select(ROW, F.col("_of").alias(LOAD))
        return cards.join(join_side(dead, state["changed"]), [ROW, LOAD], "left_anti")

    def _open(self, state: dict) -> RegisterSide:
        side = RegisterSide(self._live(state, "rows").drop(ROW, LOAD), self.threshold, self.metric)
        side.two_key, side.stored = self._live(state, "two_key").drop(ROW, LOAD), True
        side.keys = side.two_key.select("r_name", "r_father").distinct()
        for part in ("names", "fathers"):
            values = self._table(state, f"{part}/values").drop(LOAD)
            more = {p: self._table(state, f"{part}/{p}").drop(LOAD) for p in ("segments", "variants", "lengths")} if self.threshold < 1 else {}
            lengths = more["lengths"].distinct() if more else None
            setattr(side, part, EditIndex.from_tables(values, more.get("segments"), more.get("variants"), lengths, self.threshold, VALUE, self.metric))
        return side
