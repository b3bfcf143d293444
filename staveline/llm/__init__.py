"""Operators for large training corpora; nothing else of the library imports them."""
