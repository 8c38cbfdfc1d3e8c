"""Sensor-series derivation and feature statistics."""
