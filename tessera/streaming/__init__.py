"""Tessera streaming."""
