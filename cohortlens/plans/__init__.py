"""Whole jobs, and the views that give the given tables their roles."""
