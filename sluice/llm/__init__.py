"""Training-data operators: quality, tokens, near-duplicates, language, leaks, toxicity, LM scores, mixing.

Nothing else in the library imports this subpackage.
"""
