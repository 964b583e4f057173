"""Contracts, catalogues and assembly plans."""
