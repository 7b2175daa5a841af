"""landloom.sources."""
