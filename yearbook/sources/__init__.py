"""Readers for raw snapshots, dimensions, configurations and the warehouse."""
