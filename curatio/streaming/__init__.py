"""Stateless curate steps on streaming sources."""
