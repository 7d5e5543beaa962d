"""Operators that a training-data pipeline needs: formatting, deduplication,
quality, tokens, search, filters, mixing and licence scans."""
