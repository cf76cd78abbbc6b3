"""Labelled-text analytics on Spark: ingest, clean, classify, route, evaluate, monitor."""
