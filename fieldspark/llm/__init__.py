"""Operators for large text corpora: deduplication, filters, extraction, archives, mixing."""
