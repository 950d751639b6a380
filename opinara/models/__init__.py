"""Spark ML stages: features, training, evaluation and scoring."""
