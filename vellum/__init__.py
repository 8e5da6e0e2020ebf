"""Vellum: text-corpus curation on Spark DataFrames."""
