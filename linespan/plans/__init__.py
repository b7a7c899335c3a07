"""Composed plans: analytics views, dashboard reads, serving export, refresh."""
