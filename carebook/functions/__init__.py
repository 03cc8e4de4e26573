"""carebook.functions: shared column expressions."""
