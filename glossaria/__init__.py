"""A Spark engine for comparative wordlist corpora and training-data corpora."""
