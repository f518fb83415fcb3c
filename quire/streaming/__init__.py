"""quire.streaming."""
