"""Operators for language-model training data; nothing outside this folder imports it but the entry file."""
