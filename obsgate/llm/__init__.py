"""Training-data operators: quality, decontamination, toxicity, extraction, dedup, PII, packing, records."""
