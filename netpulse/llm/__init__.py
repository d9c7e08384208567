"""Operators for preparing training text: quality, duplicates, tokens, packing, archives."""
