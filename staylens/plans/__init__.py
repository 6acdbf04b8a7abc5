"""Plans: compositions of operators (refresh, incremental merge, backfill, gate)."""
