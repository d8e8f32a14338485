"""Training-data operators: scoring, deduplication, mixing and encoding of documents."""
