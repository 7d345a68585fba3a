"""Registered queries, their SQL, and whole builds."""
