"""Whole stages of the lifecycle, composed from the operators."""
