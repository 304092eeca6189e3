"""Relational operators over documents, mentions and vocabularies."""
