"""Structured Streaming pipelines. Every query takes its checkpoint location as an argument."""
