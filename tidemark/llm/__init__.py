"""Operators for large training corpora: filters, de-duplication, scans, scoring, packing."""
