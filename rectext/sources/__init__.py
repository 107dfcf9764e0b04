"""Readers (S1-S11)."""
