"""Operators for training data: token counts, filters, fingerprints, near-duplicates, language models, mixing."""
