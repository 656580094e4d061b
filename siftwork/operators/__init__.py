"""Relational operators of figure and document curation."""
