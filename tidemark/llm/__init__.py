"""Training-data operators: media, tokenizers, search, near duplicates, mixing, sharding."""
