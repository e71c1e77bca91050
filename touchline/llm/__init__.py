"""Operators for building training data from documents, embeddings, pages and conversations."""
