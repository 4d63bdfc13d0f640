"""Scans: raw files, processed readings, result files and the run log."""
