"""Whole jobs and the driver's query catalogue."""
