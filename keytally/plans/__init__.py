"""keytally.plans."""
