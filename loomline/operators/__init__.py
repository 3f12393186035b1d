"""Relational operators on documents with arrays parallel to their lines."""
