"""Registered queries over the supplied test tables and their oracle SQL."""
