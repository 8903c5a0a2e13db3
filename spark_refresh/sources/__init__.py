"""Readers of control data and copied tables, and the snapshot folders state lives in."""
