"""Training-data operators: toxicity, BPE, top-k, sharding, token files, quality rules, mixing, language ID, near-duplicates, licences.

Nothing outside this subpackage imports it.
"""
