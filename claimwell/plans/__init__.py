"""Stages, runs over arrived files, and the registered queries."""
