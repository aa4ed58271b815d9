"""Operators for building training corpora: language, archives, duplicates, leaks, mixtures,
chat text, embeddings and page text. Nothing else in the library imports this package."""
