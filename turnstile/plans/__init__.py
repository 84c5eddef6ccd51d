"""Tables and reports built from the operators."""
