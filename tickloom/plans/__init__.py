"""Operators put together: the feature build and the training run."""
