"""Registered queries over the supplied tables, with the SQL that gives the same rows."""
