"""Linkage datasets derived from the driver's test tables (whole tables, no row filters).

The test tables hold no persons, so the register, the pending queue and the
gazetteers are look-alikes built with Spark from them.  Every input row is
kept; deterministic rules on the row's own columns decide its spelling.

* register  <- ``part``: one card per part.  ``NAME`` is the part name plus
  the key spelt in letters (digits 0-9 -> a-j, since ``clean_name`` deletes
  digits), so names are near-unique and the join output grows linearly.
  ``FATHERNAME`` is ``p_type`` + first word of ``p_name`` (blank when
  ``p_size % 10 = 0``); block code = ``p_size % 25`` (a nation key, 4 digits);
  category = ``p_type``; district = ``p_brand``.
  Every 19th card number occurs again, for another person of district ``Second``.
* pending   <- ``customer`` joined with ``nation``, ``region`` and, where there is one, the
  part of the same key (its name): the queue of incoming records.  Its spelling
  varies by ``c_custkey``: reversed, upper-cased with double spaces, one
  key letter off, or the key's last two letters swapped; fathers blank (``--``), null, unknown or one letter longer;
  addresses null, a short typo of the nation, a bare pin, or the full
  ``customer, nation, region, segment``.
* blocks    <- ``nation`` (code = 4-digit key) and ``region`` (code ``R`` + 3 digits).
* pins      <- distinct digit runs of ``supplier.s_name`` and one six-digit pin per supplier.

``ORACLE_CTE`` states the same derivation in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.session import join_side
from reglink.sources.readers import read_table

# Fixed spelling rule: digit d -> the d-th letter.
DIGITS = "0123456789"
DIGIT_LETTERS = "abcdefghij"


def spell(c: Column) -> Column:
    return F.translate(c.cast("string"), DIGITS, DIGIT_LETTERS)


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    own = part.select(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("PERMANENT_RCNO"),
        F.concat_ws(" ", "p_name", spell(F.col("p_partkey"))).alias("NAME"),
        F.when(F.col("p_size") % 10 == 0, F.lit(""))
         .otherwise(F.concat_ws(" ", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1))))
         .alias("FATHERNAME"),
        F.lpad((F.col("p_size") % 25).cast("string"), 4, "0").alias("BlockMunicipalityCode"),
        F.col("p_type").alias("RCCATEGORY"),
        F.regexp_replace("p_brand", "#", "_").alias("district"),
    )
    # every 19th card number is also another person's in a second district
    again = part.where(F.col("p_partkey") % 19 == 0).select(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("PERMANENT_RCNO"),
        F.concat_ws(" ", "p_name", spell(F.col("p_partkey") + 1)).alias("NAME"),
        F.concat_ws(" ", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1))).alias("FATHERNAME"),
        F.lpad((F.col("p_size") % 25).cast("string"), 4, "0").alias("BlockMunicipalityCode"),
        F.col("p_type").alias("RCCATEGORY"), F.lit("Second").alias("district"))
    return own.unionByName(again)


def pin_text(key: Column) -> Column:
    """A six-digit pin of one state (all start with 7)."""
    return F.concat(F.lit("7"), F.lpad((key * 7919 % 100000).cast("string"), 5, "0"))


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    # nation and region are fixed 25/5-row dimensions: broadcast is size-safe
    df = (cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
              .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
              .join(join_side(part), cust.c_custkey == part.p_partkey, "left")     # a small file may hold many cards
              .withColumn("p_name", F.coalesce("p_name", F.lit("unnamed")))
              .withColumn("p_type", F.coalesce("p_type", F.lit("unknown"))))
    k = F.col("c_custkey")
    base = F.concat_ws(" ", "p_name", spell(k))
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    key = spell(k)
    # last two letters of the spelt key swapped: 2 Levenshtein edits, 1 Damerau edit
    swapped = F.concat(F.expr("substring(translate(CAST(c_custkey AS STRING), '0123456789', 'abcdefghij'), 1, "
                              "length(CAST(c_custkey AS STRING)) - 2)"),
                       F.substring(key, -1, 1), F.substring(key, -2, 1))
    name = (F.when(k % 7 == 0, F.reverse(base))
             .when(k % 7 == 1, F.concat(F.upper(F.replace(base, F.lit(" "), F.lit("  "))), F.lit(".")))
             .when(k % 7 == 2, F.concat_ws(" ", "p_name", spell(k + 1)))
             .when((k % 7 == 3) & (k >= 10), F.concat_ws(" ", "p_name", swapped))
             .otherwise(base))
    father = (F.when(k % 11 == 0, F.lit("--"))
               .when(k % 11 == 1, F.lit(None).cast("string"))
               .when(k % 11 == 2, F.lit("Unknown"))
               .when(k % 11 == 3, F.concat(F.concat_ws(" ", "p_type", first), F.lit("e")))
               .otherwise(F.concat_ws(" ", "p_type", first)))
    address = (F.when(k % 13 == 0, F.lit(None).cast("string"))
                .when(k % 13 == 1, F.concat("n_name", F.lit("x")))
                .when(k % 13 == 2, pin_text(k))
                .otherwise(F.concat_ws(", ", "c_name", "n_name", "r_name", "c_mktsegment")))
    return df.select(
        k.alias("death_main_id"),
        name.alias("DEATH_DECEASED_NAME"),
        father.alias("DEATH_FATHER_NAME"),
        address.alias("death_address"),
    )


def pending_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pending main table: ``is_send = 1`` for rows already handed out
    (customers with a negative balance), ``file_name`` = upload file."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    p = pending(spark, sf_dir)
    return p.join(join_side(cust), p.death_main_id == cust.c_custkey).select(
        F.col("death_main_id").alias("id"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).alias("is_send"),
        F.col("DEATH_DECEASED_NAME").alias("death_name"),
        F.col("DEATH_FATHER_NAME").alias("death_father_name"),
        "death_address",
        F.concat(F.lit("upload_"), F.lower("c_mktsegment"), F.lit(".csv")).alias("file_name"),
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw upload rows (all strings) before ingest: the pending names plus
    address parts; ``row_id`` only identifies the row in query output."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = pending(spark, sf_dir)
    df = (p.join(join_side(cust), p.death_main_id == cust.c_custkey)
           .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    return df.select(
        k.alias("row_id"),
        "DEATH_DECEASED_NAME", "DEATH_FATHER_NAME",
        none.alias("DEATH_SPOUSE_NAME"), none.alias("DEATH_DATE"), none.alias("DEATH_BASE_REGN_DATE"),
        (k % 90).cast("string").alias("DEATH_AGE_YEAR"),
        F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("DEATH_SEX"),
        F.col("c_name").alias("DEATH_RESIDENCE"),
        F.when(k % 3 == 0, none).otherwise(F.concat(F.lit("Street "), F.col("c_nationkey").cast("string")))
         .alias("DEATH_RESIDENCE_STREET"),
        F.when(k % 5 == 0, F.lit("Ward 4")).otherwise(none).alias("DEATH_RESIDENCE_PREMISES"),
        F.col("n_name").alias("DEATH_RESIDENCE_DIST"),
        F.col("r_name").alias("DEATH_RESIDENCE_STATE"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.select(
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("BlockCode"),
        F.col("n_name").alias("BlockName"),
    ).unionByName(region.select(
        F.concat(F.lit("R"), F.lpad(F.col("r_regionkey").cast("string"), 3, "0")).alias("BlockCode"),
        F.col("r_name").alias("BlockName"),
    ))


def pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    digits = sup.select(F.regexp_extract("s_name", "[0-9]+", 0).alias("Pincode")).where(F.col("Pincode") != "")
    return digits.unionByName(sup.select(pin_text(F.col("s_suppkey")).alias("Pincode"))).distinct()


# The same derivation in SQL (DuckDB), prepended to every oracle query.
ORACLE_CTE = """
register AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS PERMANENT_RCNO,
         p_name || ' ' || translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abcdefghij') AS NAME,
         CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type || ' ' || split_part(p_name, ' ', 1) END AS FATHERNAME,
         lpad(CAST(p_size % 25 AS VARCHAR), 4, '0') AS BlockMunicipalityCode,
         p_type AS RCCATEGORY,
         replace(p_brand, '#', '_') AS district
  FROM part
  UNION ALL
  SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS PERMANENT_RCNO,
         p_name || ' ' || translate(CAST(p_partkey + 1 AS VARCHAR), '0123456789', 'abcdefghij') AS NAME,
         p_type || ' ' || split_part(p_name, ' ', 1) AS FATHERNAME,
         lpad(CAST(p_size % 25 AS VARCHAR), 4, '0') AS BlockMunicipalityCode,
         p_type AS RCCATEGORY, 'Second' AS district
  FROM part WHERE p_partkey % 19 = 0
),
pending AS (
  SELECT c_custkey AS death_main_id,
         CASE WHEN c_custkey % 7 = 0 THEN reverse(p_name || ' ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij'))
              WHEN c_custkey % 7 = 1 THEN upper(replace(p_name || ' ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij'), ' ', '  ')) || '.'
              WHEN c_custkey % 7 = 2 THEN p_name || ' ' || translate(CAST(c_custkey + 1 AS VARCHAR), '0123456789', 'abcdefghij')
              WHEN c_custkey % 7 = 3 AND c_custkey >= 10 THEN p_name || ' ' ||
                   substr(translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij'), 1, length(CAST(c_custkey AS VARCHAR)) - 2) ||
                   right(translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij'), 1) ||
                   substr(translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij'), length(CAST(c_custkey AS VARCHAR)) - 1, 1)
              ELSE p_name || ' ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') END AS DEATH_DECEASED_NAME,
         CASE WHEN c_custkey % 11 = 0 THEN '--'
              WHEN c_custkey % 11 = 1 THEN NULL
              WHEN c_custkey % 11 = 2 THEN 'Unknown'
              WHEN c_custkey % 11 = 3 THEN p_type || ' ' || split_part(p_name, ' ', 1) || 'e'
              ELSE p_type || ' ' || split_part(p_name, ' ', 1) END AS DEATH_FATHER_NAME,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 13 = 1 THEN n_name || 'x'
              WHEN c_custkey % 13 = 2 THEN '7' || lpad(CAST(c_custkey * 7919 % 100000 AS VARCHAR), 5, '0')
              ELSE concat_ws(', ', c_name, n_name, r_name, c_mktsegment) END AS death_address
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
                JOIN (SELECT c_custkey AS p_partkey, coalesce(p_name, 'unnamed') AS p_name, coalesce(p_type, 'unknown') AS p_type
                      FROM customer LEFT JOIN part ON p_partkey = c_custkey) ON p_partkey = c_custkey
),
blocks AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS BlockCode, n_name AS BlockName FROM nation
  UNION ALL
  SELECT 'R' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS BlockCode, r_name AS BlockName FROM region
),
pending_main AS (
  SELECT death_main_id AS id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_send,
         DEATH_DECEASED_NAME AS death_name, DEATH_FATHER_NAME AS death_father_name, death_address,
         'upload_' || lower(c_mktsegment) || '.csv' AS file_name
  FROM pending JOIN customer ON death_main_id = c_custkey
),
uploads AS (
  SELECT c_custkey AS row_id, DEATH_DECEASED_NAME, DEATH_FATHER_NAME,
         CAST(NULL AS VARCHAR) AS DEATH_SPOUSE_NAME, CAST(NULL AS VARCHAR) AS DEATH_DATE,
         CAST(NULL AS VARCHAR) AS DEATH_BASE_REGN_DATE, CAST(c_custkey % 90 AS VARCHAR) AS DEATH_AGE_YEAR,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS DEATH_SEX,
         c_name AS DEATH_RESIDENCE,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Street ' || CAST(c_nationkey AS VARCHAR) END AS DEATH_RESIDENCE_STREET,
         CASE WHEN c_custkey % 5 = 0 THEN 'Ward 4' ELSE NULL END AS DEATH_RESIDENCE_PREMISES,
         n_name AS DEATH_RESIDENCE_DIST, r_name AS DEATH_RESIDENCE_STATE
  FROM pending JOIN customer ON death_main_id = c_custkey
               JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey
),
pins AS (
  SELECT regexp_extract(s_name, '[0-9]+', 0) AS Pincode FROM supplier
  WHERE regexp_extract(s_name, '[0-9]+', 0) <> ''
  UNION
  SELECT '7' || lpad(CAST(s_suppkey * 7919 % 100000 AS VARCHAR), 5, '0') AS Pincode FROM supplier
)"""
