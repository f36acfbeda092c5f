"""File sources and sinks.

Readers take explicit schemas (inference is an option). Connector formats
(document stores, wide-column stores, JDBC) are plain ``format``/``options``
arguments of the same writers; the defaults are parquet, CSV and JSON.
"""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import clean
from ..operators.materialize import remove_path

# The reviews CSV layout of the source jobs (15 columns) and the
# stand-in layout used with the test tables (9 columns).
REVIEWS_SCHEMA_FULL = (
    "marketplace string, customer_id bigint, review_id string, product_id string, "
    "product_parent bigint, product_title string, product_category string, star_rating int, "
    "helpful_votes int, total_votes int, vine int, verified_purchase int, review_headline string, "
    "review_body string, review_date string")
REVIEWS_SCHEMA = (
    "customer_id bigint, review_id string, product_id string, product_category string, "
    "star_rating int, verified_purchase int, review_headline string, review_body string, "
    "review_date string")
CAMPAIGNS_SCHEMA = (
    "campaign_id string, advertiser_name string, campaign_name string, campaign_start_date date, "
    "campaign_end_date date, criteria string, ad_slot_size string, budget decimal(12,2), "
    "remaining_budget decimal(12,2)")
USERS_SCHEMA = ("user_id string, age int, gender string, location string, interests string, signup_date date")
STAGING_SCHEMA = (
    "event_id string, advertiser_name string, campaign_name string, campaign_start_date date, "
    "campaign_end_date date, budget decimal(12,2), remaining_budget decimal(12,2), criteria string, "
    "interest string, country string, ad_slot_size string, user_id string, device string, "
    "location string, event_ts timestamp_ntz, bid_amount decimal(10,4), ad_cost decimal(10,4), "
    "was_clicked string, click_timestamp string, ad_revenue decimal(10,4)")
# DATETIME text with microseconds (the writer's default keeps milliseconds only).
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

CSV_OPTIONS = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"',
    "mode": "PERMISSIVE", "timestampNTZFormat": TS_FORMAT,
    # keep leading blanks (" Germany"): the CSV writer strips them by default
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


# Written NULLs are empty unquoted fields and empty strings are ``""``; on
# read only the unquoted empty field may become NULL (the default nullValue
# "" would turn ``""`` into NULL as well).
_READ_NULL = "\u0000"


#: Writer options of text files that hold many or repeated texts: gzip at its
#: fastest. Readers unpack by the file name; a packed file is read by one task.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: The codec that Spark brings along for parquet, whose class serves text files
#: as well. Readers know its files (``.zstd``) by ``UNPACK`` alone: without it
#: they would take the packed bytes for text.
ZSTD = "org.apache.parquet.hadoop.codec.ZstandardCodec"
ZSTD_LEVEL = "parquet.compression.codec.zstd.level"
#: Writer options where whole texts repeat: gzip sees 32 KB back, which a long
#: text fills by itself, zstd some megabytes.
PACKED_WIDE = {"compression": ZSTD, ZSTD_LEVEL: "5"}
UNPACK = {"io.compression.codecs": ZSTD}


#: Column that holds the raw text of a record that doesn't fit its schema.
RECORD = "_record"


def _texts(df: DataFrame, change) -> DataFrame:
    """``df`` with ``change`` applied to every text column."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string" and f.name != RECORD]
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in texts}) if texts else df


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, escaped: bool = False,
             **options: str) -> DataFrame:
    """Header CSV, ``,`` separated, ``"`` quoted; explicit schema,
    or inferred types when ``schema`` is None.

    One record per line, so that a large file is split over many tasks.
    ``escaped`` files are those of ``write_csv``, whose texts hold line breaks
    as escapes: they are undone. For foreign files with quoted line breaks pass
    ``multiLine="true"`` (one task per file). A header that differs from the
    schema fails instead of shifting columns."""
    r = spark.read.options(**{**CSV_OPTIONS, "nullValue": _READ_NULL, "enforceSchema": "false", **options})
    r = r.schema(schema) if schema else r.option("inferSchema", "true")
    return _texts(r.csv(path), clean.whole_text) if escaped else r.csv(path)


def read_with_rejects(spark: SparkSession, path: str, schema: str, escaped: bool = False,
                      **options: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV: rows that fit the schema, typed; and the others
    (a number or date that is none, too few or too many fields) with all their
    fields as text and the raw line as ``_record``. No row is lost, none
    has fields that silently became NULL."""
    typed = StructType.fromDDL(schema)
    marked = StructType([*typed.fields, StructField(RECORD, StringType())])
    both = read_csv(spark, path, marked, False, columnNameOfCorruptRecord=RECORD, **options)
    # a field is only checked if it is read: every query reads all, whatever it selects
    fits = reduce(Column.__add__, [F.col(f"`{f.name}`").isNotNull().cast("int") for f in typed.fields])
    both = both.where(fits <= len(typed.fields))
    # not as a null check: the parser would apply that before it knows of a bad field
    bad = F.coalesce(F.col(RECORD), F.lit("")) != ""
    rows = both.where(~bad).drop(RECORD)
    # the header check compares the file with the schema, which a single record has not
    again = {**CSV_OPTIONS, "nullValue": _READ_NULL, **options, "header": "false"}
    as_text = ", ".join(f"`{f.name}` string" for f in typed.fields)
    rejects = both.where(bad).select(RECORD, F.from_csv(RECORD, as_text, again).alias("f")).select("f.*", RECORD)
    return (_texts(rows, clean.whole_text), _texts(rejects, clean.whole_text)) if escaped else (rows, rejects)


_log = logging.getLogger(__name__)


def read_reviews_csv(spark: SparkSession, path: str | None = None, infer: bool = False,
                     schema: str = REVIEWS_SCHEMA_FULL, **options) -> DataFrame:
    """S1 (explicit schema of 15 columns, all nullable) and S2 (``infer=True``).
    Without a ``path`` the ``INPUT_PATH`` environment variable names the input."""
    path = path or os.environ.get("INPUT_PATH")
    if not path:
        raise ValueError("no input path: pass path= or set INPUT_PATH")
    return read_csv(spark, path, None if infer else schema, **options)


def load_staging(spark: SparkSession, path: str, schema: str = STAGING_SCHEMA, escaped: bool = False) -> DataFrame:
    """S3: typed staging table from CSV."""
    return read_csv(spark, path, schema, escaped)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """One record a line, whatever the texts hold (``read_csv(escaped=True)``
    gives them back)."""
    _texts(df, clean.one_record).write.mode(mode).options(**{**CSV_OPTIONS, **options}).csv(path)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the observation that holds ``n_rows`` once it is written: the
    write counts its own rows, nothing is scanned again."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def replace_load(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Write each table as CSV under ``root`` replacing what was there, and
    report ``(table_name, n_rows)``, as counted by the writes."""
    counts = []
    for name, df in tables.items():
        rows, seen = counted(df)
        write_csv(rows, f"{root.rstrip('/')}/{name}")
        counts.append((name, seen.get["n_rows"]))
    return spark.createDataFrame(counts, "table_name string, n_rows bigint")


def write_documents(df: DataFrame, path: str | None = None, fmt: str = "json", mode: str = "overwrite",
                    **options: str) -> int:
    """Replace (``overwrite``) or extend (``append``) a document
    collection; returns how many documents were written. ``fmt`` may name a
    connector (e.g. a document store) whose options (database, collection)
    pass through. JSON files are packed: every interaction of a document
    repeats its event and campaign."""
    rows, seen = counted(df)
    packed = PACKED if fmt == "json" else {}
    w = rows.write.format(fmt).mode(mode).options(**{"timestampNTZFormat": TS_FORMAT, **packed, **options})
    w.save(path) if path else w.save()
    return seen.get["n_rows"]


def read_documents(spark: SparkSession, path: str, schema, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).schema(schema).option("timestampNTZFormat", TS_FORMAT).load(path)


def safe_name(name: str) -> str:
    """Report name -> file name (``[^0-9a-zA-Z_]+`` -> ``_``, lower case)."""
    return re.sub(r"[^0-9a-zA-Z_]+", "_", name).lower()


def report_rows(reports: Mapping[str, DataFrame]) -> DataFrame:
    """All reports in long form ``(report, row_json)``."""
    parts = [df.select(F.lit(name).alias("report"), F.to_json(F.struct(*df.columns)).alias("row_json"))
             for name, df in reports.items()]
    return reduce(DataFrame.unionByName, parts)


def write_report_bundle(reports: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One CSV folder per report plus one JSON bundle of all rows.

    Every report runs once: it is written, and all that follows reads what was
    written. A report that fails is recorded and skipped; an empty report
    leaves no file. Returns ``{report: "written" | "empty" | "error: ..."}``.
    """
    status: dict[str, str] = {}
    ok: dict[str, DataFrame] = {}
    for name, df in reports.items():
        path = report_path(out_dir, name)
        try:
            write_csv(df, path)
            stored = read_report(df.sparkSession, out_dir, name, df.schema)
            if stored.isEmpty():
                remove_path(df.sparkSession, path)
                status[name] = "empty"
                continue
            status[name] = "written"
            ok[name] = stored
        except Exception as e:  # one bad report must not stop the others
            status[name] = f"error: {type(e).__name__}: {e}"
            _log.warning("report %s skipped: %s", name, status[name])
    if ok:
        report_rows(ok).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/full_report")
    return status


def report_path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{safe_name(name)}"


def read_report(spark: SparkSession, out_dir: str, name: str, schema) -> DataFrame:
    """A written report, with its types."""
    return read_csv(spark, report_path(out_dir, name), schema, escaped=True)


def report_fields(report: DataFrame, name: str, key: str) -> DataFrame:
    """A report in long form: ``(report, row_key, field, value)``, one row per
    value; fractions with six decimals, so that engines spell them alike."""
    fields = [f for f in report.schema.fields if f.name != key]
    texts = [(F.col(f.name).cast("decimal(38,6)") if f.dataType.typeName() == "double" else F.col(f.name))
             .cast("string").alias(f.name) for f in fields]
    return (report.select(F.col(key).cast("string").alias("row_key"), *texts)
            .unpivot("row_key", [f.name for f in fields], "field", "value")
            .select(F.lit(name).alias("report"), "row_key", "field", "value"))
