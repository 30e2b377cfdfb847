"""Layered analytics tables on Spark: ingest, clean, model, check and report."""
