"""Training-data operators: language models, quality, archives, shards, duplicates, packing."""
