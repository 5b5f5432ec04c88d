"""Rewrites made before Catalyst sees a query, and statement parsing."""
