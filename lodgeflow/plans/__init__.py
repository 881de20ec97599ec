"""lodgeflow.plans."""
