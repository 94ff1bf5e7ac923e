"""Readers, writers and record shapes of the event lake."""
