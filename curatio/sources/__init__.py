"""Scans, side lists, inline dimensions and attachment payloads."""
