"""Registered queries: one for each operator, over the driver's tables."""
