"""Operators put together: registered queries with their SQL, and whole flows."""
