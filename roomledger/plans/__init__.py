"""Compositions: the query registry, its DuckDB oracle, and the end-to-end batch pipeline."""
