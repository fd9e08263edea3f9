"""Readers and writers: documents, vocabularies, link caches, published tables."""
