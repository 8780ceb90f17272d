"""Whole flows made of the operators: ingest, promote, rebuild, replay; and the query registry."""
