"""Training-data operators: deduplication, filters, language and toxicity models, packing."""
