"""Operators for large text corpora: dedup, PII, URL filters, WARC, licences, mixing, toxicity, packing."""
