"""Queries over the projected test tables and their checking SQL."""
