"""Operators: contracts, upserts, schema evolution, watermark state, batching."""
