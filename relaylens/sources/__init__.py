"""Sources (landed CSV/JSON files, listings) and sinks (append writers)."""
