"""Readers, writers, decoders and the adapters over the driver tables."""
