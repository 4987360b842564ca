"""End-to-end data products (P-1 .. P-14)."""
