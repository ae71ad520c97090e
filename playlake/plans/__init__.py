"""Composite dataflows and the query bindings to the driver's tables."""
