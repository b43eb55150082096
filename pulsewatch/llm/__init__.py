"""Training-data operators: web archives, fingerprints, personal data, toxicity,
near-duplicates, packing, repeated passages, benchmark leaks, main text, secrets,
line quality, embedding whitening, vector codebooks.

Nothing else in the library imports this subpackage.
"""
