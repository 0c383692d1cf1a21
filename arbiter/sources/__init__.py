"""Sources and sinks: topics, spool files, trace/log files, snapshots, seed rows."""
