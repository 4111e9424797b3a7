"""Corpora of structured legal text on Spark: catalogs, line and tree operators, links, rendering, validation."""
