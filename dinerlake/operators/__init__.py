"""Reusable DataFrame to DataFrame operators."""
