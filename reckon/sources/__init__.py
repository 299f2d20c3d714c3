"""Sources and sinks: table catalog, CSV ingest, month snapshots, named outputs per cycle."""
