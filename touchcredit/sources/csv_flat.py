"""Flat CSV events (S4) and their cleaning.

Every field is read as text against an explicit schema (no inference);
the two integer columns and the revenue are cast afterwards, with
``try_cast`` so one junk line yields NULLs instead of failing the job.
Empty text stands for NULL in source, medium, campaign and revenue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit.functions import columns as fc
from touchcredit.sources.schemas import CSV_COLUMNS, CSV_FLAT_TEXT  # noqa: F401  (re-exported)

CLEAN_COLUMNS = ["event_date", "event_timestamp", "event_ts_seconds", "event_name", "user_pseudo_id",
                 "ga_session_id", "source", "medium", "campaign", "purchase_revenue"]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV files (one or many; Spark splits large files)."""
    return spark.read.schema(CSV_FLAT_TEXT).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_csv(flat: DataFrame, path: str, drop: int = 0) -> None:
    """Write flat rows as header CSV, without the last ``drop`` columns; NULL becomes nothing, empty text a quoted blank."""
    columns = CSV_COLUMNS[: len(CSV_COLUMNS) - drop]
    flat.select(*[F.col(c).cast("string") for c in columns]).write.mode("overwrite") \
        .option("header", True).option("escape", '"').csv(path)


#: The whole line of a row whose fields do not fit the schema.
CORRUPT = "_corrupt_record"
REJECT_COLUMNS = [*CSV_COLUMNS, "reason", "line"]


def read_checked(spark: SparkSession, paths: str | list[str], quoted_newlines: bool = False) -> DataFrame:
    """Header CSV files as text columns and ``_corrupt_record``, the line of a row with too few or too many fields.

    With ``quoted_newlines`` a quoted field may hold line ends; a file is then one task's, since no split can tell
    a quoted line end from another. Without it, large files are split."""
    schema = T.StructType([*CSV_FLAT_TEXT.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", quoted_newlines)
            .option("columnPruning", False).csv(paths))  # a pruned row would not show that its fields do not fit


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``read_checked`` -> good rows (text columns), and the reject table: the fields as far as they were
    read, the reason (``fields``, or the first column that is not the number it should be) and the line.

    Blank numbers are NULL, not rejected; a timestamp has to be there."""
    def junk(name: str, kind: str):
        return F.when((F.coalesce(F.col(name), F.lit("")) != "") & F.col(name).try_cast(kind).isNull(), F.lit(name))

    reason = F.coalesce(
        F.when(F.col(CORRUPT).isNotNull(), F.lit("fields")),
        F.when(F.coalesce(F.col("event_timestamp"), F.lit("")).try_cast("bigint").isNull(), F.lit("event_timestamp")),
        junk("ga_session_id", "bigint"), junk("purchase_revenue", "double"))
    told = rows.withColumn("reason", reason)
    return (told.where("reason is null").select(*CSV_COLUMNS),
            told.where("reason is not null").withColumnRenamed(CORRUPT, "line").select(*REJECT_COLUMNS))


def to_csv_lines(stg: DataFrame) -> DataFrame:
    """Flat staging rows -> one CSV text line each (column ``value``),
    NULL as empty text, as a flat export would hold them."""
    return stg.select(F.to_csv(F.struct(*[F.col(c).cast("string") for c in CSV_COLUMNS])).alias("value"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """CSV text lines -> text columns (same schema as ``read_csv``)."""
    ddl = ", ".join(f"{c} string" for c in CSV_COLUMNS)
    return lines.select(F.from_csv("value", ddl).alias("r")).select("r.*")


def clean(text_rows: DataFrame) -> DataFrame:
    """Text columns -> typed staging columns."""
    ts = F.col("event_timestamp").try_cast("bigint")
    return text_rows.select(
        "event_date",
        ts.alias("event_timestamp"),
        (ts / F.lit(1_000_000.0)).alias("event_ts_seconds"),
        "event_name",
        "user_pseudo_id",
        F.col("ga_session_id").try_cast("bigint").alias("ga_session_id"),
        fc.blank_to_null("source").alias("source"),
        fc.blank_to_null("medium").alias("medium"),
        fc.blank_to_null("campaign").alias("campaign"),
        fc.text_to_double(F.coalesce(F.col("purchase_revenue"), F.lit(""))).alias("purchase_revenue"),
    )


def to_staging(clean_rows: DataFrame) -> DataFrame:
    """Cleaned CSV rows -> the staging relation (same columns as the
    export path; the flat file is a batch feed)."""
    from touchcredit import config as C
    from touchcredit.sources.schemas import STG_COLUMNS
    return clean_rows.select(
        *[c for c in clean_rows.columns if c != "event_ts_seconds"],
        fc.micros_to_ts("event_timestamp").alias("event_ts"),
        F.lit(C.BATCH_TAG).alias("_source"),
    ).select(*STG_COLUMNS)
