"""reportflow.streaming."""
