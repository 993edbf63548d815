"""Readers: files, tables, archives, and paged services behind one interface."""
