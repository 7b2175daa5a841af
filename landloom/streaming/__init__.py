"""landloom.streaming."""
