"""Column expressions.  No UDFs: everything stays inside Catalyst."""
