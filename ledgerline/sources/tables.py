"""Reading feeds and lookups, with declared schemas and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The flat sales feed, in file order. item_nbr stays text because a few
# rows carry a letter prefix.
SALES_FEED = T.StructType(
    [
        T.StructField("item_invoice_nbr", T.StringType()),
        T.StructField("order_dt", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("store_address", T.StringType()),
        T.StructField("store_city", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("store_location", T.StringType()),
        T.StructField("county_nbr", T.IntegerType()),
        T.StructField("county_name", T.StringType()),
        T.StructField("category_nbr", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("vendor_nbr", T.IntegerType()),
        T.StructField("vendor_name", T.StringType()),
        T.StructField("item_nbr", T.StringType()),
        T.StructField("item_desc", T.StringType()),
        T.StructField("pack", T.IntegerType()),
        T.StructField("bottle_vol", T.IntegerType()),
        T.StructField("state_bottle_cost", T.DoubleType()),
        T.StructField("state_bottle_retail", T.DoubleType()),
        T.StructField("bottles_sold", T.IntegerType()),
        T.StructField("sale", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("volume_gallons", T.DoubleType()),
    ]
)

# Primary keys of the warehouse tables.
PRIMARY_KEYS = {
    "sales_feed": ["item_invoice_nbr"],
    "category": ["category_nbr", "start_date"],
    "vendor": ["vendor_nbr", "start_date"],
    "item": ["item_nbr", "start_date"],
    "store": ["store_nbr", "start_date"],
    "item_detail": ["item_hash"],
    "store_address": ["store_hash"],
    "county": ["county_nbr"],
    "orders": ["item_invoice_nbr"],
}

CORRUPT = "_corrupt_record"


def load_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    delimiter: str = ",",
    date_format: str = "yyyy-MM-dd",
    multi_line: bool = False,
    check_header: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """A header CSV as (good rows, rejected lines), typed by ``schema`` and never by inference.

    A record that does not fit the schema goes whole to the rejected side. With
    ``multi_line`` a quoted field may hold line breaks; a file is then one task's, so feeds
    of that kind should come as many files. With ``check_header`` a header that is not the schema's
    column names in order raises.
    """
    if check_header:
        first = spark.read.option("sep", delimiter).option("escape", '"').option("header", True).csv(path).columns
        if first != schema.names:
            raise ValueError(f"the header has {first}, the schema {schema.names}")
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(full)
        .option("header", True)
        .option("sep", delimiter)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("dateFormat", date_format)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    # The reader converts only the columns a query uses, and so would pass a line whose bad
    # column is not selected. This test is always true but needs every column.
    all_read = F.xxhash64(*schema.names) >= F.lit(-(2**63))
    good = raw.filter(F.col(CORRUPT).isNull() & all_read).select(*(columns or schema.names))
    return good, raw.filter(F.col(CORRUPT).isNotNull() & all_read)


def load_csv_head(
    spark: SparkSession, path: str, schema: T.StructType, overrides: Mapping[str, str], rows: int | None
) -> DataFrame:
    """A CSV with some columns read as other types (mixed ones as text), all of it or ``rows`` rows at most."""
    fields = [
        T.StructField(f.name, T.DataType.fromDDL(overrides[f.name]) if f.name in overrides else f.dataType)
        for f in schema.fields
    ]
    read = spark.read.schema(T.StructType(fields)).option("header", True).option("escape", '"').csv(path)
    return read if rows is None else read.limit(rows)


def load_lookups(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """A fact and its lookup files by name."""
    return {name: load_csv(spark, path, schemas[name])[0] for name, path in paths.items()}


def parse_day(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(column, F.to_date(F.col(column), pattern))


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once, with their count; empty for a valid key."""
    some_null = None
    for c in key:
        some_null = F.col(c).isNull() if some_null is None else some_null | F.col(c).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | some_null)


def non_numeric_keys(df: DataFrame, column: str, *describe: str, also: Sequence[str] = ()) -> DataFrame:
    """Keys that are not made of digits and dots (and the ones in ``also``), counted."""
    odd = ~F.col(column).rlike(r"^[0-9\.]+$")
    if also:
        odd = odd | F.col(column).isin(list(also))
    return df.filter(odd).groupBy(column, *describe).agg(F.count("*").alias("n"))
