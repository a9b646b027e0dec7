"""Operators for preparing training text at scale. Optional: nothing else in
the library imports this subpackage."""
