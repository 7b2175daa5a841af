"""landloom.functions."""
