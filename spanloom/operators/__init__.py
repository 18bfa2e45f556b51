"""Relational operators of the span-extraction plan."""
