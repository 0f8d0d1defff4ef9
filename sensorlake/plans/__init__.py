"""Composed plans: cleaning, reports, and the registered query set."""
