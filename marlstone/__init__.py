"""Layered retail analytics on PySpark: ingest, cleanse, model, serve."""
