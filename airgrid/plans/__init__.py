"""Whole jobs: cleaning, training, scoring."""
