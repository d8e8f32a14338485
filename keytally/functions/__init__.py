"""keytally.functions."""
