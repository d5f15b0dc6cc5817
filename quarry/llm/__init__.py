"""Operators for large training-data pipelines (see README, "Training-data operators")."""
