"""reportflow.functions."""
