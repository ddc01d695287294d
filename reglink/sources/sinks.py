"""Sinks (K1-K9).  Every write is one DataFrame write, idempotent: a run owns
its output and replaces it as a whole, instead of appending duplicates or
leaving rows that the new run no longer yields.  Evidence of all kinds is switched in one step."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.sources import registry

EVIDENCE_KINDS = ("block", "pin", "person")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2: overwrite a whole table."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_register(df: DataFrame, path: str) -> None:
    """K1: the register as one dataset partitioned by district."""
    df.write.mode("overwrite").partitionBy("district").parquet(path)


def write_chunks(df: DataFrame, path: str, files: int | None = None) -> None:
    """K3: pending rows with ``chunk_id`` as a column.  Whole chunks per file (range-partitioned by
    chunk), many chunks in one: the number of files follows the bytes (or ``files``), not the queue."""
    ranged = df.repartitionByRange(files, "chunk_id") if files else df.repartitionByRange("chunk_id")
    ranged.write.mode("overwrite").parquet(path)


COMMITS = "_commits"        # numbered entries; the last one names the live run of every kind and owner
GONE = "_gone"


class EvidenceRun:
    """K5-K7: one writer's evidence, seen as a whole or not at all.

    Each kind goes to a fresh folder ``path/kind/run=...``.  ``publish`` then enters one line in the registry that
    switches all kinds of the ``owner`` (a run date's batch run, or one batch of a stream) to this run, so a re-run that
    yields less leaves nothing old behind, and one that fails half-way leaves the earlier evidence as it was.  The
    folders that a commit replaces are removed by the next one: who reads them still has until then."""

    def __init__(self, spark, path: str, owner: str):
        self.spark, self.path, self.owner, self.run = spark, path.rstrip("/"), owner, uuid.uuid4().hex[:16]
        self.kinds: list[str] = []

    def write(self, kind: str, df: DataFrame, fmt: str = "parquet") -> DataFrame:
        """Write one kind and read it back."""
        if kind not in EVIDENCE_KINDS:
            raise ValueError(f"kind must be one of {EVIDENCE_KINDS}")
        self.kinds.append(kind)
        folder = _run_folder(self.path, kind, self.run)
        df.write.format(fmt).save(folder)
        return self.spark.read.schema(df.schema).format(fmt).load(folder)

    def publish(self, replaces: list[str] | None = None) -> None:
        """Switch to this run; runs of the owners in ``replaces`` are live no more, as they are part of it."""
        while True:
            number, state = _commit(self.spark, self.path)
            before, state[GONE] = state.get(GONE, []), []
            for kind in self.kinds:
                runs = state.setdefault(kind, {})
                state[GONE] += [[kind, runs.pop(o)] for o in (self.owner, *(replaces or [])) if o in runs]
                runs[self.owner] = self.run
            if registry.add(self.spark, f"{self.path}/{COMMITS}", number + 1, json.dumps(state)):
                break
        for kind, run in before:
            registry.remove(self.spark, _run_folder(self.path, kind, run))

    def __enter__(self) -> "EvidenceRun":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            for k in self.kinds:
                registry.remove(self.spark, _run_folder(self.path, k, self.run))


def _run_folder(path: str, kind: str, run: str) -> str:
    return f"{path.rstrip('/')}/{kind}/run={run}"


def _commit(spark, path: str) -> tuple[int, dict]:
    number, line = registry.latest(spark, f"{path.rstrip('/')}/{COMMITS}")
    return number, json.loads(line) if number else {}


def live_runs(spark, path: str, kind: str) -> dict[str, str]:
    """Owner to folder of the evidence of a kind that holds now."""
    return {owner: _run_folder(path, kind, run) for owner, run in _commit(spark, path)[1].get(kind, {}).items()}


def append_evidence(df: DataFrame, path: str, kind: str, run_date: str, owner: str | None = None,
                    fmt: str = "parquet") -> None:
    """K4-K7: one kind of evidence of one run, in place of what its owner had before."""
    with EvidenceRun(df.sparkSession, path, owner or f"run-{run_date}") as run:
        run.write(kind, df.withColumn("run_date", F.lit(run_date)), fmt)


def fold_batches(spark, path: str, stream: str, before: int, most: int = 64) -> None:
    """Keep a stream's evidence in few folders: once ``most`` of its batches (numbered below ``before``, so none of them
    is run again) are live, they become one folder, and ``most`` of these one of the next level; a row is
    rewritten once a level."""
    for level in range(12):
        prefix = f"{stream}-" if level == 0 else f"{stream}-fold{level}-"
        owners = sorted(o for o in live_runs(spark, path, EVIDENCE_KINDS[0]) if o.startswith(prefix) and o[len(prefix):].isdigit()
                        and int(o[len(prefix):]) < before)
        if len(owners) < most:
            return
        run = EvidenceRun(spark, path, f"{stream}-fold{level + 1}-{owners[-1][len(prefix):]}")
        for kind in EVIDENCE_KINDS:
            folders = live_runs(spark, path, kind)
            run.write(kind, spark.read.parquet(*[folders[o] for o in owners]))
        run.publish(owners)


def write_owned(df: DataFrame, path: str, owner: str, fmt: str = "parquet") -> None:
    """Replace what ``owner`` has below ``path``."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(f"{path.rstrip('/')}/owner={owner}")


# Headers of the CSV evidence files.
CSV_HEADERS = {
    "block": [("death_main_id", "death_main_id"), ("block_id", "blockcode")],
    "pin": [("death_main_id", "death_main_id"), ("matched_pin", "pincode")],
    "person": [("death_main_id", "death_main_id"), ("rc_no", "PERMANENT_RCNO"), ("rc_name", "NAME"),
               ("rc_father_name", "FATHERNAME"), ("rc_blockmunicipalitycode", "BlockMunicipalityCode"),
               ("rc_category", "RCCATEGORY")],
}


def write_evidence_csv(df: DataFrame, path: str, kind: str, run_date: str) -> None:
    """K4: the dated CSV evidence with the source files' headers, replaced per run date."""
    out = df.select(*[F.col(a).alias(b) for a, b in CSV_HEADERS[kind]])
    write_owned(out, f"{path.rstrip('/')}/{kind}_csv", f"run-{run_date}", "csv")
