"""keytally.sources."""
