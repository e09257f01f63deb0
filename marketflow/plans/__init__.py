"""Registered queries over the supplied tables, each beside the SQL it is checked against."""
