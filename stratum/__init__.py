"""Layered ingestion on Spark: raw files and messages in, current rows and daily summaries out."""
