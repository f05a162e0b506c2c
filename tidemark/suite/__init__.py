"""Registered queries, each beside the SQL text that must give the same rows."""
