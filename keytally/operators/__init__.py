"""keytally.operators."""
