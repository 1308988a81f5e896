"""Landed pages, messages, bronze files and the skill taxonomy."""
