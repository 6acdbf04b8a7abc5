"""Landing: raw request bodies -> labelled events -> bronze rows + quarantine rows.

``land`` is one narrow projection (no shuffle): parse once to VARIANT, derive
the bronze columns, and attach a ``reason`` (NULL = accepted). Callers persist
the labelled frame once and write both outputs from it (``bronze_rows`` /
``quarantine_rows``), so ids and timestamps agree across sinks.

Gates:
* ``"light"`` — the stream path: the body must be a JSON object with a truthy
  ``hotel_id`` and ``timestamp`` (reason ``missing_required_fields``); the
  timestamp must parse (``invalid_timestamp``) so search_date is never NULL.
* ``"full"``  — the request path: the whole contract (V1-V24) must hold
  (reason ``validation_failed``, errors listed).
Both gates first test that the body is a JSON object (``invalid_json``); the
request path also caps the body's size (``payload_too_large``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staylens import reference_data as R
from staylens.functions import json as J
from staylens.functions.dates import strict_timestamp
from staylens.functions.keys import dedup_key, key_parts
from staylens.operators.validation import BUSINESS_CODES, CODE_NOT_JSON, error, no_errors, with_errors

# FIXED VALUES: dead-letter reasons.
REASON_TOO_LARGE = "payload_too_large"
REASON_INVALID_JSON = "invalid_json"
REASON_MISSING = "missing_required_fields"
REASON_BAD_TIMESTAMP = "invalid_timestamp"
REASON_VALIDATION = "validation_failed"
REASON_VERSION = "unsupported_schema_version"
# FIXED VALUES: codes of errors that only landing finds.
CODE_PRESENCE = "root.presence"
CODE_SIZE = "root.size"
CODE_VERSION = "root.version"

# JSON spellings of empty values; numbers are compared with 0 (the string "0" is not empty).
_FALSY_JSON = ["null", "false", '""', "[]", "{}"]


def _falsy(v: Column, field: str) -> Column:
    j = F.to_json(J.node(v, field))
    zero = ~j.startswith('"') & F.coalesce(J.number(v, field) == 0, F.lit(False))
    return j.isNull() | j.isin(*_FALSY_JSON) | zero


def land(raw: DataFrame, gate: str = "light", partner_id: str = R.PARTNER_ID,
         schema_version: str = R.SCHEMA_VERSION, max_bytes: int | None = None,
         known_countries=None, currencies=None) -> DataFrame:
    """Label each raw body; returns bronze columns + ``reason``, ``errors``, ``raw``.

    ``max_bytes`` None: the request cap with gate="full", no cap on the stream path.
    """
    if gate not in ("light", "full"):
        raise ValueError(f"unknown gate {gate!r}")
    if max_bytes is None and gate == "full":
        max_bytes = R.MAX_REQUEST_BYTES
    cols = set(raw.columns)
    event_id = F.col("request_id") if "request_id" in cols else F.expr("uuid()")
    received = F.col("received_at") if "received_at" in cols else F.current_timestamp()
    # The version travels with each message (bus header); absent = the default.
    version = (F.coalesce(F.col("schema_version"), F.lit(schema_version)) if "schema_version" in cols
               else F.lit(schema_version))
    v = F.col("_v")
    body = F.col("value")
    ts = F.col("_ts")
    # Valid JSON whose first non-blank character is '{' is an object: a cheap
    # test on the text instead of rendering the VARIANT's full type string.
    is_obj = body.rlike(r"^[ \t\r\n]*\{")

    if gate == "light":
        errors = (F.when(F.col("_missing"),
                         F.array(error("root", CODE_PRESENCE, "hotel_id and timestamp are required")))
                  .when(ts.isNull(), F.array(error("timestamp", BUSINESS_CODES["timestamp"], "invalid datetime format")))
                  .otherwise(no_errors()))
        gate_reason = (F.when(F.col("_missing"), REASON_MISSING)
                       .when(ts.isNull(), REASON_BAD_TIMESTAMP))
    else:
        errors = F.col("_contract_errors")
        gate_reason = F.when(F.size(F.col("errors")) > 0, REASON_VALIDATION)

    too_large = F.octet_length(body) > max_bytes if max_bytes is not None else F.lit(False)
    not_json = v.isNull() | ~is_obj
    staged = J.with_parsed(raw.select(event_id.cast("string").alias("event_id"),
                                      received.cast("timestamp").alias("ingestion_time"),
                                      body.alias("value"), version.alias("schema_version")), "value")
    # read once a row: the gate, the reason and the columns all use these
    facts = {"_ts": strict_timestamp(J.text(v, "timestamp")), **key_parts(v)}
    if gate == "light":
        facts["_missing"] = _falsy(v, "hotel_id") | _falsy(v, "timestamp")
    staged = J.evaluated(staged, facts)
    if gate == "full":
        staged = with_errors(staged, "_v", "_contract_errors", known_countries=known_countries,
                             currencies=currencies)
    labelled = (staged
                .withColumn("errors", F.when(~F.col("schema_version").isin(*R.ACCEPTED_SCHEMA_VERSIONS),
                                             F.array(error("root", CODE_VERSION, F.format_string(
                                                 "unsupported schema version %s", F.col("schema_version")))))
                            .when(too_large, F.array(error("root", CODE_SIZE, F.format_string(
                                "body of %d bytes exceeds %d", F.octet_length(body), F.lit(max_bytes or 0)))))
                            .when(not_json, F.array(error("root", CODE_NOT_JSON, "invalid JSON")))
                            .otherwise(errors))
                .withColumn("reason", F.when(~F.col("schema_version").isin(*R.ACCEPTED_SCHEMA_VERSIONS),
                                             REASON_VERSION)
                            .when(body.isNull(), REASON_INVALID_JSON)
                            .when(too_large, REASON_TOO_LARGE)
                            .when(not_json, REASON_INVALID_JSON)
                            .otherwise(gate_reason)))
    return labelled.select(
        "event_id",
        dedup_key().alias("dedup_key"),
        "ingestion_time",
        F.lit(partner_id).alias("partner_id"),
        "schema_version",
        F.col("value").alias("payload"),
        J.integer(v, "hotel_id").alias("hotel_id"),
        ts.alias("search_timestamp"),
        F.to_date("ingestion_time").alias("ingest_date"),
        "reason",
        "errors",
    )


BRONZE_COLUMNS = ["event_id", "dedup_key", "ingestion_time", "partner_id", "schema_version",
                  "payload", "hotel_id", "search_timestamp", "ingest_date"]


def bronze_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("reason").isNull()).select(*BRONZE_COLUMNS)


def quarantine_rows(labelled: DataFrame, attempts: int | Column = 1) -> DataFrame:
    """Dead letters: reason, errors (path, code, message) and the body (its first 500 chars when it is no JSON object)."""
    short = F.col("reason") == REASON_INVALID_JSON
    return (labelled.filter(F.col("reason").isNotNull())
            .select("event_id", "ingestion_time", "schema_version", "reason", "errors",
                    F.when(short, F.substring("payload", 1, R.DLQ_RAW_CHARS)).otherwise(F.col("payload")).alias("raw"),
                    (attempts if isinstance(attempts, Column) else F.lit(attempts)).cast("int").alias("attempts"),
                    "ingest_date"))
