"""quire.functions."""
