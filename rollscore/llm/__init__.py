"""Training-data operators: decontamination, mixing, archives, language id,
vector search, toxicity, token files, near-duplicates, repeated spans, secrets,
conversation tries, whitening, similarity hashes."""
