"""Whole jobs built from the operators, and the verification queries."""
