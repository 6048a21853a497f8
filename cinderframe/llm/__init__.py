"""Training-data operators: sharding, near-deduplication, PII, fingerprints, language-model scores,
web archives, packing, quality rules, source mixing and quality classification.

Nothing outside this subpackage imports it.
"""
