"""Training-data operators: deduplication, sharding, scans, conversion, tokenisation, language ID."""
