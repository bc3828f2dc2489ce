"""Readers for the raw layers."""
