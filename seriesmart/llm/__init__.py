"""Operators for preparing training text at scale, each over whole tables."""
