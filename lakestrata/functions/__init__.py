"""Column builders that stay inside Catalyst."""
