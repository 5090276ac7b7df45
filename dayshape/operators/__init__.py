"""DataFrame -> DataFrame operators, grouped by purpose."""
