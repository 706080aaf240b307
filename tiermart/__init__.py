"""Layered supply-chain and sales tables on Spark DataFrames."""
