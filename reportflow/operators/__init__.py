"""reportflow.operators."""
