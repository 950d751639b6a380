"""Registered queries: each pairs a DataFrame query with the SQL that checks it."""
