"""Retail supply-chain analytics as PySpark DataFrame operators."""
