"""Operators for building training corpora: search, sharding, records, extraction,
packing, near-duplicate detection, language identification and fingerprints."""
