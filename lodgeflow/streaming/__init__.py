"""lodgeflow.streaming."""
