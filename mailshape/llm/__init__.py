"""Training-data operators: scoring, decontamination, de-duplication, archives, extraction, privacy,
toxicity, packing, quality and URL rules. Nothing outside this subpackage imports it."""
