"""Training-data operators: quality, toxicity, privacy, duplicates, language, contamination, packing, licences."""
