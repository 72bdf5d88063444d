"""Schemas of snapshots, keyed state and ledgers."""

from __future__ import annotations

from pyspark.sql import types as T

#: The source's fields, all read as text.
FIELDS = ("id", "ovd", "insert_date", "nz", "imei", "nk", "dk", "dtl")

SNAPSHOT = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])

#: Current state: one row for each key ever seen.
STATE = T.StructType(
    [T.StructField("record_key", T.StringType())]
    + [T.StructField(f, T.StringType()) for f in FIELDS[1:]]
    + [T.StructField("extra_json", T.StringType()), T.StructField("content_hash", T.StringType())]
    + [T.StructField(n, T.DateType()) for n in ("first_seen", "last_seen", "disappeared_at", "returned_at")]
    + [T.StructField("is_present", T.BooleanType()), T.StructField("revision_no", T.IntegerType()), T.StructField("disappeared_count", T.IntegerType())]
    + [T.StructField("first_source", T.StringType()), T.StructField("last_source", T.StringType())]
)

#: One row for each (source, day): what was read and what became of it.
LEDGER = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("api_hash", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("read_mode", T.StringType()),
        T.StructField("rows_raw", T.LongType()),
        T.StructField("rows_dupe_id", T.LongType()),
        T.StructField("rows_repaired", T.LongType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("appeared", T.LongType()),
        T.StructField("changed", T.LongType()),
        T.StructField("missing", T.LongType()),
        T.StructField("disappeared", T.LongType()),
        T.StructField("is_suspect", T.BooleanType()),
        T.StructField("suspect_reason", T.StringType()),
    ]
)

REVISION = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("snapshot_date", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("api_hash", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("created", T.StringType()),
        T.StructField("skip_reason", T.StringType()),
    ]
)
