"""Modelling on the unit-year fact with Spark ML."""
