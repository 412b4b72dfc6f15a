"""Scans of postings and taxonomies, and input validation."""
