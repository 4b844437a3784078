"""Readers for text, bulk dumps, pages, listings and stored periods."""
