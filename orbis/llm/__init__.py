"""Operators of a training-data pipeline: deduplication, quality, packing,
licence and URL rules, tokenizer work.  Nothing outside this folder imports it."""
