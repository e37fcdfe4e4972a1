"""Corpus readers and the tab-separated text form of an index."""
