"""Training-data operators: extraction, filtering, deduplication, tokenizing."""
