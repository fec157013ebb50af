"""Training-data operators: licence scans, near-duplicate removal, language
identification, fingerprints, sharding, packing, tokenization, page text."""
