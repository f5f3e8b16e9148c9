"""The event feed."""
