"""Training-data operators: sharding, packing, quality, extraction, archives, tokens, dedup, filters, language."""
