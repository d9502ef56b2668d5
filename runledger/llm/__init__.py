"""Operators over text corpora: filters, deduplication, mixing, packing."""
