"""Whole jobs: the refresh cycle, the table copy, the batch and the reports."""
