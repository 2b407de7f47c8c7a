"""Training-data operators: fingerprints, near-dedup, sharding, web archives,
source mixing, quality models, sub-word coding, language id, token files."""
