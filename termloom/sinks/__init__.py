"""Where results go: stored indexes and text reports."""
