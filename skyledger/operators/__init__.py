"""Relational building blocks: rollups, reconciliation, trends, latest rows, audits."""
