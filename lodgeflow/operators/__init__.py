"""lodgeflow.operators."""
