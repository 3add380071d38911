"""Tessera: record curation and labelling on Spark DataFrames."""
