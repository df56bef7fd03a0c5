"""Operators for training-data pipelines. Nothing outside this folder imports them but the guarded entry."""
