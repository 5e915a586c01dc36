"""Training-data operators: search, filtering, deduplication, mixing, tokenising and packing.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` at the
repository top chains five of its operators.
"""
