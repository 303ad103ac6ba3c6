"""Whole runs: documents to clean tables, clean tables to the published
tables, published tables to the star schema, and the reports that read them."""
