"""Whole runs: candidate, gate, snapshot, lineage."""
