"""End-to-end compositions of the operators and the registered query catalogue."""
