"""quire.sources."""
