"""Composed tables: silver, gold marts, views, metrics and reports."""
