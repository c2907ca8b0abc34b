"""Sources (scans with declared schemas) and sinks."""
