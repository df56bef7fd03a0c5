"""Tessera: a DataFrame-first analytics engine on PySpark."""
