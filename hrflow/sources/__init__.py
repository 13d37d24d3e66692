"""Readers. Each returns a DataFrame; nothing is collected."""
