"""Training-data operators: near-duplicates, quality, secrets, toxicity, byte-level BPE, vector search,
packing, language ID and substring de-duplication. Nothing else in the package imports this subpackage."""
