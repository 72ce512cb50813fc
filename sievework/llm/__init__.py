"""Operators on texts and labels for training data. Nothing outside imports this package."""
