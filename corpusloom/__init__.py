"""Builds, aligns, audits and curates parallel text corpora with Spark DataFrames."""
