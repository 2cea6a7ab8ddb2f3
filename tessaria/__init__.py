"""Tessaria: corpus canonicalisation and training-data operators on Spark DataFrames."""
