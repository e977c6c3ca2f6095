"""Queries over the generated tables and the SQL that checks them."""
