"""Operators on observation tables, tracks and echo samples."""
