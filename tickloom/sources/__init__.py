"""Decoders of raw feeds and readers of stored tables."""
