"""landloom.operators."""
