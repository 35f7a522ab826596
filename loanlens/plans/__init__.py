"""Whole result tables built from the operators and functions."""
