"""Readers: every source becomes a DataFrame with real NULLs and known types."""
