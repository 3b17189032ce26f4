"""Readers and decoders."""
