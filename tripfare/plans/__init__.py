"""Whole-study plans built from the operators."""
