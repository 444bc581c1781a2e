"""Citizen-complaint and public-safety analytics written as Spark DataFrame operators."""
