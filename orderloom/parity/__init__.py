"""Queries over the star-schema test tables, and the SQL each of them must agree with."""
