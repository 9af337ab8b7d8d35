"""Operators for training data: splits, time matching, percentiles, tokens, mixtures, subjects."""
