"""Table builders: bronze loads, silver dimensions and facts, marts."""
