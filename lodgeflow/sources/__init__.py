"""lodgeflow.sources."""
