"""Work-queue operators: pending count, chunk assignment, id lists, ledger.

The reference claims pending rows 100 at a time.  Here a chunk number is a
column: ``chunk_id = ceil(position / size)`` with ``position`` the 1-based
rank by key.  A global ``row_number()`` window would run in one task, so the
rank is computed in two passes: range-partition by key and sort within
partitions, checkpoint (so both passes see the same partitions), count rows
per partition, turn the counts (one row per partition) into offsets, and add
each row's index within its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.sources import registry

LOCAL_BITS = 33  # monotonically_increasing_id = (partition << 33) + index in partition


def pending_only(main: DataFrame, flag: str = "is_send") -> DataFrame:
    """P10: rows not yet handed out (``is_send = 0``), pushed to the scan."""
    return main.where(F.col(flag) == 0)


def pending_count(main: DataFrame, key: str = "id", flag: str = "is_send") -> DataFrame:
    """A1: ``count(id) where is_send = 0``."""
    return pending_only(main, flag).agg(F.count(key).alias("pending_count"))


def chunk_count(main: DataFrame, size: int = C.CHUNK_SIZE, key: str = "id", flag: str = "is_send") -> DataFrame:
    """A1 + A3: pending rows and ``ceil(count / size)`` chunks."""
    return pending_count(main, key, flag).select(
        "pending_count", F.ceil(F.col("pending_count") / F.lit(size)).cast("long").alias("chunk_count"))


def assign_positions(df: DataFrame, key: str, num_partitions: int | None = None,
                     tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``position`` = 1-based rank by ``key`` (then ``tiebreak``) without a
    single-partition window.  With a non-unique key, ``tiebreak`` columns let
    the range partitioner split a hot key value across partitions."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [key, *(tiebreak or [])]
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in order]).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))))
    # reliable checkpoint (shared checkpoint dir): survives executor loss and
    # pins the partition contents for the two passes below
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: this window and broadcast are bounded by n
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn("position", (F.col("_off") + F.col("_local") + 1).cast("long")).drop("_pid", "_local", "_off")


def assign_chunks(df: DataFrame, size: int = C.CHUNK_SIZE, key: str = "id", num_partitions: int | None = None,
                  tiebreak: list[str] | None = None) -> DataFrame:
    """``chunk_id`` (1-based) of consecutive groups of ``size`` rows by ``key``."""
    pos = assign_positions(df, key, num_partitions, tiebreak)
    return pos.withColumn("chunk_id", ((F.col("position") - 1) / F.lit(size)).cast("long") + 1)


def chunk_name(chunk_id) -> Column:
    """a 9-character chunk name, deterministic (replayable) instead of random."""
    c = F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id
    return F.upper(F.substring(F.md5(c.cast("string")), 1, 9))


def chunk_id_lists(chunked: DataFrame, key: str = "id") -> DataFrame:
    """A5: per chunk the sorted comma-separated id list (a chunk is at most
    ``size`` rows, so ``collect_list`` is bounded) and the chunk's name."""
    return chunked.groupBy("chunk_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("id_list")
    ).select("chunk_id", chunk_name("chunk_id").alias("chunk_name"), "id_list")


def ids_from_list(lists: DataFrame, col: str = "id_list", key: str = "id") -> DataFrame:
    """split a comma list back into one row per id (T-SQL ``f_split``).
    Empty items (``1,,2``) yield nothing; a non-numeric item yields a null id
    (``try_cast``: no ANSI failure), which matches nothing downstream."""
    keep = [c for c in lists.columns if c != col]
    items = lists.select(*keep, F.explode(F.split(F.col(col), ",")).alias("_v")).where(F.trim("_v") != "")
    return items.select(*keep, F.trim("_v").try_cast("long").alias(key))


LEDGER_SCHEMA = "id bigint, chunk_id bigint, claim string"


CLAIMS = "_claims"      # which claims hold: one entry each, in order
ATTEMPTS = 100


def read_ledger(spark, path: str) -> DataFrame:
    """Claimed ids so far (K8); empty before the first claim.  Rows of a claim count once it is entered."""
    claims = registry.entries(spark, f"{path.rstrip('/')}/{CLAIMS}")
    if not claims:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    folders = [f"{path.rstrip('/')}/claim={c}" for c in claims]
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", path).parquet(*folders)


def claim_pending(main: DataFrame, ledger: DataFrame | None = None, n_chunks: int = 1, size: int = C.CHUNK_SIZE,
                  key: str = "id", flag: str = "is_send") -> DataFrame:
    """``(key, chunk_id)`` of the next ``n_chunks`` chunks that no ledger row holds.

    Ids in the ledger leave before numbering, and chunk numbers go on after the ledger's."""
    todo, done = pending_only(main, flag).select(key), 0
    if ledger is not None:
        todo = todo.join(ledger.select(F.col("id").alias(key)), key, "left_anti")
        done = ledger.agg(F.coalesce(F.max("chunk_id"), F.lit(0)).alias("n")).first()["n"]
    chunked = assign_chunks(todo, size, key)
    return (chunked.where(F.col("chunk_id") <= n_chunks)
            .select(key, (F.col("chunk_id") + F.lit(done)).cast("long").alias("chunk_id")))


def mark_claimed(claim: DataFrame, path: str, claim_id: str, number: int, key: str = "id") -> bool:
    """K8: write a claim's rows to a folder of its own, then enter it as the ledger's claim ``number``; False if
    another claim has that number, and then these rows do not count."""
    path = path.rstrip("/")
    claim.select(F.col(key).cast("long").alias("id"), "chunk_id").write.mode("overwrite").parquet(f"{path}/claim={claim_id}")
    return registry.add(claim.sparkSession, f"{path}/{CLAIMS}", number, claim_id)


def claim_next(main: DataFrame, path: str, claim_id: str, n_chunks: int, size: int = C.CHUNK_SIZE,
               key: str = "id", flag: str = "is_send") -> DataFrame:
    """S7 + K8: claim the next chunks and mark them.

    Claimers exclude each other: a claim holds if it is entered as the number after those that it has seen; if another
    one came first, the next chunks are worked out again.  A claim that holds already is handed out again as it
    was.  ``claim_id`` belongs to one caller."""
    spark, folder = main.sparkSession, f"{path.rstrip('/')}/{CLAIMS}"
    for _ in range(ATTEMPTS):
        held = registry.entries(spark, folder)
        if claim_id not in held:
            claim = claim_pending(main, read_ledger(spark, path) if held else None, n_chunks, size, key, flag)
            if not mark_claimed(claim, path, claim_id, len(held) + 1, key):
                continue
        mine = spark.read.schema("id bigint, chunk_id bigint").parquet(f"{path.rstrip('/')}/claim={claim_id}")
        return mine.withColumnRenamed("id", key)
    raise RuntimeError(f"claim {claim_id}: others came first {ATTEMPTS} times")


def to_pending(main: DataFrame) -> DataFrame:
    """Rows of the main table as the matcher reads them."""
    extra = [c for c in main.columns if c in ("chunk_id", "file_name")]
    return main.select(F.col("id").alias("death_main_id"), F.col("death_name").alias("DEATH_DECEASED_NAME"),
                       F.col("death_father_name").alias("DEATH_FATHER_NAME"), "death_address", *extra)


def still_pending(main: DataFrame, ledger: DataFrame, key: str = "id", flag: str = "is_send") -> DataFrame:
    """Pending rows whose id is not in the ledger (left anti join)."""
    return pending_only(main, flag).join(ledger.select(key), key, "left_anti")
