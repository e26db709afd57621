"""Compositions: experiment runs, derived tables and the registered query catalog."""
