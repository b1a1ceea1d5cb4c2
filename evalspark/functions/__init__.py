"""Column builders: rules for one value, used inside the table jobs."""
