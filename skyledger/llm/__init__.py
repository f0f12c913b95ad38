"""Operators that clean, measure and encode text collections for language-model training."""
