"""Composed jobs: preparation, training/evaluation flows, the query catalog."""
