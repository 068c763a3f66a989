"""All registered queries and their SQL."""

from obsgate.plans import ingest_checks, ingest_oracle, oracle, tables

QUERIES = tables.QUERIES | ingest_checks.QUERIES
ORACLE = oracle.ORACLE | ingest_oracle.ORACLE
