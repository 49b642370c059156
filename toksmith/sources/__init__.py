"""Corpus sources and model sinks."""
