"""Preparation of training data: ten operators on corpora, one module each."""
