"""Readers: every path, format and bound is a parameter."""
