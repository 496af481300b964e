"""Readers: field templates, lookup tables, published tables, saved stages."""
