"""The refresh cycle as a Structured Streaming query."""
