"""Registered queries over the driver's tables, each with its independent SQL where one exists."""
