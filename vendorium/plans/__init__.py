"""Report definitions over the clean, history and audit tables."""
