"""Layered ingestion on Spark: landing files and event streams to raw and refined tables."""
