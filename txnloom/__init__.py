"""Cleaning and enrichment of card-transaction records on Spark, batch or stream."""
