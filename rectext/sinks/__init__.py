"""Writers (K1-K6)."""
