"""keytally.streaming."""
