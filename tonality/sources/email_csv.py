"""The e-mail CSV (S3, S4): declared schema, never inferred.

RFC-4180 style quoting: fields are quoted when needed, quotes inside are doubled,
line breaks inside quotes stay in the field (``multiLine``).  Leading and trailing
blanks are kept on write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .fixtures import email_schema

CSV_OPTIONS = {"quote": '"', "escape": '"', "sep": ","}


def write_email_csv(df: DataFrame, path: str, header: bool = True,
                    compression: str | None = None) -> None:
    w = (df.write.mode("overwrite").options(**CSV_OPTIONS)
         .option("header", header)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_email_csv(spark: SparkSession, path: str, header: bool = True,
                   all_strings: bool = False) -> DataFrame:
    """The 27 declared columns; ``.gz`` files decompress by suffix.  Values that do not
    parse as their declared type become null (PERMISSIVE)."""
    return (spark.read.schema(email_schema(all_strings)).options(**CSV_OPTIONS)
            .option("header", header).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX")
            .csv(path))
