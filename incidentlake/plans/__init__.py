"""Jobs and query bundles composed from the operators."""
