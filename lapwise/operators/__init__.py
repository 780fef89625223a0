"""Domain-free building blocks: ordered frames, pairs, upsert, metrics, masking."""
