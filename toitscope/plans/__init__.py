"""The analyses: market prices, energy, run history, comparisons, and the load as a whole."""
