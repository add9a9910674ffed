"""Training-data operators: tokenising, archives, quality, toxicity, search, duplicates, packing, scoring."""
