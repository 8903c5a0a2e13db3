"""Transitions of the work queue as DataFrame functions of the old state."""
