"""Sources and sinks: declared schemas, CSV ingest, table sinks, catalog reports, fixture views."""
