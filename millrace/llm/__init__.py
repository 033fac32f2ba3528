"""Operators for the text of language-model corpora; nothing else in the library imports them."""
