"""Sources and sinks: driver tables, the raw-contacts bridge, ingest steps and writers."""
