"""Sources and sinks: source reads, staging, target snapshots, history, reports."""
