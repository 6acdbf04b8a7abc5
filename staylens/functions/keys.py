"""Deterministic keys derived from an event."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from staylens.functions import json as J

# Fields of the dedup key, in order; a missing or null field is spelled 'None'.
DEDUP_FIELDS = ["hotel_id", "timestamp", "user_country", "arrival_date"]
MISSING = "None"


def key_parts(v: Column) -> dict[str, Column]:
    """Type and text of every key field, to be read once a row (``json.evaluated``)."""
    return {f"_key_{part}_{f}": c for f in DEDUP_FIELDS
            for part, c in (("type", F.schema_of_variant(J.node(v, f))), ("text", J.text(v, f)))}


def _spelled(field: str) -> Column:
    """The scalar as the key spells it: text as it is, 1235.0 not as 1235, true as True."""
    kind, text = F.col(f"_key_type_{field}"), F.col(f"_key_text_{field}")
    whole = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    return (F.when(kind == "STRING", text).when(kind == "BOOLEAN", F.initcap(text))
            .when(whole & ~text.rlike("[.eE]"), F.concat(text, F.lit(".0"))).otherwise(text))


def dedup_key() -> Column:
    """sha256 hex of ``hotel_id|timestamp|user_country|arrival_date``, from the ``key_parts`` columns.

    ``concat_ws`` alone would skip NULLs and shift the fields, so each part is
    coalesced to the missing marker first. A number with a fraction part keeps it
    (1235.0) and booleans are spelled True / False.
    """
    parts = [F.coalesce(_spelled(f), F.lit(MISSING)) for f in DEDUP_FIELDS]
    return F.sha2(F.concat_ws("|", *parts), 256)
