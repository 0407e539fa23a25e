"""Operators of a training-data pipeline: licence scans, decontamination,
secret scans, substring dedup, sharding, pseudonyms, similarity join, packing,
fingerprints and a line-level quality model."""
