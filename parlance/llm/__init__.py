"""Training-data operators (token counts, chat formatting, byte-level BPE, decontamination,
language ID, quality, line dedup, Jaccard join, toxicity, PII). Nothing else in the library
imports this subpackage."""
