"""Sources and sinks: driver tables, patient views, CSV/zip scans, snapshots, runs log."""
