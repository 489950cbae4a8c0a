"""Readers: filing indexes, filing documents, the raw landing zone."""
