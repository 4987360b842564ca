"""Relational building blocks shared by the data products."""
