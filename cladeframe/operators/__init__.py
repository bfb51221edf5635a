"""Operators on domain tables."""
