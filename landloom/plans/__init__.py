"""landloom.plans."""
