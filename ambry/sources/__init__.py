"""Sources: table reads, reference-shaped inputs, incremental scans, CSV."""
