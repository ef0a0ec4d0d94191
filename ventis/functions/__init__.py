"""Column expressions. Everything here stays inside Catalyst; there are no Python UDFs."""
