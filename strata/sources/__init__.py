"""Sources and sinks: hub events, the raw landing zone, JSON document folders,
Parquet tables (batch and stream)."""
