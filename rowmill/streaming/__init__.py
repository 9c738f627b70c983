"""Stateless steps on streams of files."""
