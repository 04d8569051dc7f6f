"""Relational building blocks: lookups, anti/semi joins, unions, pack split."""
