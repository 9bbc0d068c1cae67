"""Operators for large text-training corpora; nothing else in inkwright imports this package."""
