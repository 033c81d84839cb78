"""Wiring: operators joined into a star schema, its build, and the registered queries."""
