"""Ready-made loads composed of the operators, and the table-backed checks."""
