"""Composite jobs, each one lazy plan over the operators."""
