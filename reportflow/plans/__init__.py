"""reportflow.plans."""
