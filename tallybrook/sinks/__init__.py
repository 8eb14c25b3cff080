"""Typed, repeatable writes."""
