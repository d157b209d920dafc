"""Operators on training text: tokens, duplicates, quality, archives, language models."""
