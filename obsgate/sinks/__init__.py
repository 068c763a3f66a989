"""Partitioned tables, quarantine tables and lineage-cutting staging."""
