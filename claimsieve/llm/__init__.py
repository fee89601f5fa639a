"""Operators for text corpora: mixing, deduplication, quality, language models, toxicity, licences, tokens."""
