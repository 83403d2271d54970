"""Readers, writers and the sales and finance table models."""
