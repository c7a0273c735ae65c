"""Readers, writers and the tables that documents are stored in."""
