"""Registered queries and, next to each, the SQL that checks it."""
