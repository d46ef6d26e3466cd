"""Whole jobs: several operators, one read, several result tables."""
