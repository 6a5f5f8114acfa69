"""Corpus preparation for language-model training, expressed as Spark jobs."""
