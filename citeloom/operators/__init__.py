"""Relational operators over publication corpora."""
