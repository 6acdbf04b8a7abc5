"""staylens — hotel-search analytics on Spark.

Raw search events are landed into an append-only bronze table, checked against
a versioned contract, enriched and deduplicated into silver, and rolled up into
per-city marts. Every operator is a ``DataFrame -> DataFrame`` function built on
Spark SQL / Structured Streaming built-ins; I/O happens only at the edges
(``staylens.sources``) and in the refresh plans (``staylens.plans``).
"""

__all__ = ["session", "reference_data", "schemas"]
