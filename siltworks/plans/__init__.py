"""Whole refinement plans built from the operators."""
