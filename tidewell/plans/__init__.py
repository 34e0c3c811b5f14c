"""Workloads: operators put together."""
