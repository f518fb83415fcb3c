"""quire.operators."""
