"""Posting analytics on Spark: landed feeds to a ranked, scored postings table."""
