"""End-to-end jobs: write, extract, compact, convert, load."""
