"""Modelling on the analysis table with Spark ML."""
