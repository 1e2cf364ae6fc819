"""Whole jobs and the questions asked of the cleaned table."""
