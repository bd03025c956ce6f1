"""Training-data operators: extraction, counting, deduplication, quality, licences, mixing, encoding."""
