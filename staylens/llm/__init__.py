"""Operators for preparing training text: cleaning, near copies, tokens, safety."""
