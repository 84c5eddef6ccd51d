"""Registered queries: each pairs a Spark query with the SQL that must give the same rows."""
