"""reportflow.sinks."""
