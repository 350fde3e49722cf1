"""Training-data operators: dedup, quality, chat, sharding, secrets, BPE, toxicity, decontamination, URLs."""
