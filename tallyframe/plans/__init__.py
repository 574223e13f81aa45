"""Composed plans: prepare, clean, training frame and the full run."""
