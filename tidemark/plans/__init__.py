"""Entity cleaners, marts and whole load jobs built from the operators."""
