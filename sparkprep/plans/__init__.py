"""Composed jobs: model training/scoring plans and the query catalog."""
