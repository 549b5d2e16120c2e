"""Sources and sinks.

R's ``read.csv`` infers types from content; here a schema is passed when
known (no inference pass over the data) and blank handling is explicit:
``na.strings=""`` maps blanks to null (S01), ``stringsAsFactors=FALSE``
keeps them as empty text (S02).  Parquet is the default sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_blank_null(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                        sep: str = ",") -> DataFrame:
    """``read.csv(path, header=TRUE, na.strings=c(""))``: empty and quoted
    empty fields come back as null."""
    r = spark.read.option("header", True).option("sep", sep).option("nullValue", "") \
             .option("emptyValue", None)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c) == "", None).otherwise(F.col(c)) for c in strings})


def read_csv_keep_blank(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                        sep: str = ",") -> DataFrame:
    """``read.csv(path, header=TRUE, stringsAsFactors=FALSE)``: only the text
    ``NA`` is missing; blank text fields stay empty strings (the profile counts them).

    The CSV parser reports an empty field as null, so text columns are read
    with no null marker and mapped afterwards: null -> "" and "NA" -> null.
    """
    r = spark.read.option("header", True).option("sep", sep).option("emptyValue", "")
    if schema is None:  # types are inferred with NA missing, so that it does not turn numbers into text
        schema = r.option("inferSchema", True).option("nullValue", "NA").csv(path).schema
    df = r.option("nullValue", "\u0000").schema(schema).csv(path)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c).isNull(), F.lit("")).when(F.col(c) == "NA", None)
                           .otherwise(F.col(c)) for c in strings})


def read_delimited(spark: SparkSession, path: str, sep: str = "\t",
                   schema: T.StructType | str | None = None) -> DataFrame:
    """Tab (or other) delimited text with a header."""
    return read_csv_blank_null(spark, path, schema, sep)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A named dataset: a catalog table, else a Parquet path."""
    try:
        return spark.table(name_or_path)
    except Exception:  # noqa: BLE001 - not a catalog name: treat as a path
        return spark.read.parquet(name_or_path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, na: str = "") -> None:
    """``write.csv(df, path)``; never writes row names (defect D6).

    CSV keeps a header.  Nulls are written as ``na``: empty fields, which S01 reads
    back, or ``"NA"`` as ``write.csv`` does, which S02 reads back and which keeps
    them apart from blank text.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("nullValue", na).option("emptyValue", "").csv(path)
    else:
        w.format(fmt).save(path)


def write_predictions(scored: DataFrame, path: str, keep: list[str], fmt: str = "parquet",
                      prob_col: str = "probability", class_col: str = "class") -> None:
    """Input columns plus predicted class and probability."""
    write_table(scored.select(*keep, class_col, prob_col), path, fmt)
