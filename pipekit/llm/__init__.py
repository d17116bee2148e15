"""Operators for language-model training data; each module is one operator."""
