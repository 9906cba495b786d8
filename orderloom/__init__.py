"""Retail order analytics on Spark: dated batches to a star schema and reporting marts."""
