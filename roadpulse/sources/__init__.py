"""Readers, writers and calendars."""
