"""Readers over landed files, and the postings store."""
