"""Readers and writers for the corpus, token-list, tagging and tokenizer formats."""
