"""Registered queries, the SQL that checks them, and the data both derive."""
