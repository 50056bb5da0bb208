"""Training-data operators: packing, quality, search, PII, chats, fingerprints, deduplication, BPE."""
