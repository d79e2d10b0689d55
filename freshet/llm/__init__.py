"""Operators that prepare text corpora for training: filters, scans, de-duplication, archives, sharding, tokens, languages."""
