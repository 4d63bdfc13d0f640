"""Writers: partitioned readings, result files, the run log and keyed JSON."""
