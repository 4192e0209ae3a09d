"""Jobs and report tables composed from the operators."""
