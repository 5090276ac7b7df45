"""Composed jobs, and the bindings of the operators to the test tables."""
