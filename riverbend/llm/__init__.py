"""Training-data operators: packing, sharding, near-duplicates, extraction, quality,
search, language, toxicity, tokens and token counts, each one Spark job."""
