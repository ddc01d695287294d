"""Scans (S1-S10).  Explicit schemas everywhere: inference loses leading zeros
of identifiers and types an all-empty column as double."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reglink.functions.clean import blank_to_empty

PENDING_SCHEMA = T.StructType([
    T.StructField("death_main_id", T.LongType()),
    T.StructField("DEATH_DECEASED_NAME", T.StringType()),
    T.StructField("DEATH_FATHER_NAME", T.StringType()),
    T.StructField("death_address", T.StringType()),
])

PENDING_MAIN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("is_send", T.IntegerType()),
    T.StructField("death_name", T.StringType()),
    T.StructField("death_father_name", T.StringType()),
    T.StructField("death_address", T.StringType()),
    T.StructField("file_name", T.StringType()),
])

UPLOAD_COLUMNS = [
    "DEATH_DECEASED_NAME", "DEATH_FATHER_NAME", "DEATH_SPOUSE_NAME", "DEATH_DATE",
    "DEATH_BASE_REGN_DATE", "DEATH_AGE_YEAR", "DEATH_SEX", "DEATH_RESIDENCE",
    "DEATH_RESIDENCE_STREET", "DEATH_RESIDENCE_PREMISES", "DEATH_RESIDENCE_DIST",
    "DEATH_RESIDENCE_STATE",
]
UPLOAD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in UPLOAD_COLUMNS])

REGISTER_SCHEMA = T.StructType([
    T.StructField("PERMANENT_RCNO", T.StringType()),
    T.StructField("NAME", T.StringType()),
    T.StructField("FATHERNAME", T.StringType()),
    T.StructField("BlockMunicipalityCode", T.StringType()),
    T.StructField("RCCATEGORY", T.StringType()),
])

BLOCK_SCHEMA = T.StructType([T.StructField("BlockCode", T.StringType()), T.StructField("BlockName", T.StringType())])
PIN_SCHEMA = T.StructType([T.StructField("Pincode", T.StringType())])


# Schemas of the driver's test tables: declared, so a scan needs no footer
# inference job and a change of type fails loudly instead of silently.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_options(reader, mode: str = "FAILFAST", multi_line: bool = True):
    """RFC-4180 CSV: quotes doubled inside quotes and, with ``multi_line``, line breaks inside quotes (then a file
    is one task; without, large files are split, and a row with a line break is a broken row)."""
    return (reader.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("nullValue", "\u0000").option("emptyValue", "").option("mode", mode))


def _csv(reader, path: str, multi_line: bool):
    """Broken rows fail."""
    return csv_options(reader, "FAILFAST", multi_line).csv(path)


def plain_path(path: str) -> str:
    """A path without scheme and without percent escapes: file sources write the same path in several ways."""
    from urllib.parse import unquote, urlsplit
    return "/" + unquote(urlsplit(path).path).lstrip("/")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV scan (S1-S3): columns by header *name*, others (such as an unnamed index column) ignored.

    Ids declared as strings keep their zeros; a missing column, a row that does not parse and a
    value that does not cast raise.  In a folder, a file whose header differs from the first one's
    raises too (not checked where a column has no name).  ``multi_line=False`` reads large files by several tasks;
    a quoted line break then raises."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    names = _csv(reader, path, multi_line).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {names}")
    reader = spark.read.schema(all_string_schema(names)).option("enforceSchema", any(n.startswith("_c") for n in names))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = _csv(reader, path, multi_line)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                     F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_path").alias("_path"))


def read_chunk(spark: SparkSession, path: str, schema: T.StructType = PENDING_SCHEMA, multi_line: bool = True) -> DataFrame:
    """A pending chunk written as CSV (header, with or without an index column)."""
    return read_csv(spark, path, schema, multi_line=multi_line).drop("_file", "_path")


def read_uploads(spark: SparkSession, folder: str, schema: T.StructType = UPLOAD_SCHEMA, name_from: str = "file") -> DataFrame:
    """Every ``*.csv`` in a folder (S10) with its source file name (F14), or the name of the
    file's folder (``name_from="folder"``)."""
    df = read_csv(spark, folder, schema, "*.csv")
    name = F.col("_file") if name_from == "file" else F.element_at(F.split("_path", "/"), -2)
    return df.withColumn("file_name", name).drop("_file", "_path")


def load_register(df: DataFrame) -> DataFrame:
    """The five register columns, null names -> ''."""
    return df.select(
        F.col("PERMANENT_RCNO").cast("string").alias("PERMANENT_RCNO"),
        blank_to_empty("NAME").alias("NAME"),
        blank_to_empty("FATHERNAME").alias("FATHERNAME"),
        F.col("BlockMunicipalityCode").cast("string").alias("BlockMunicipalityCode"),
        F.col("RCCATEGORY").cast("string").alias("RCCATEGORY"),
        *([F.col("district")] if "district" in df.columns else []),
    )


def load_blocks(df: DataFrame) -> DataFrame:
    """The block gazetteer."""
    return df.select(F.col("BlockCode").cast("string"), F.col("BlockName").cast("string"))


def load_pins(df: DataFrame) -> DataFrame:
    """Distinct pincodes."""
    return df.select(F.col("Pincode").cast("string")).distinct()


def union_registers(parts: dict[str, DataFrame]) -> DataFrame:
    """Per-district tables as one table with a ``district`` column."""
    frames = [load_register(df).withColumn("district", F.lit(d)) for d, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_register_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """S8 the Spark way: one dataset partitioned by ``district`` (pruned on filter)."""
    schema = T.StructType(REGISTER_SCHEMA.fields + [T.StructField("district", T.StringType())])
    return spark.read.schema(schema).parquet(path)
