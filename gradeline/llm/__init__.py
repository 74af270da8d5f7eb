"""Operators for preparing training data: archives, filters, deduplication, scoring and mixing."""
