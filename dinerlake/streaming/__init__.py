"""Incremental processing: repeatable day runs, backfill and replay.

The source has no continuous streams.  New data arrives as daily extracts, and
late rows are picked up by running their day again.
"""
