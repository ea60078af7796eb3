"""Offline mirror built from the driver's tables, and the registered queries."""
