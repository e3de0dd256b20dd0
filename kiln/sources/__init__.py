"""Readers, writers, resume/skip logic (family A) and driver-table stand-ins."""
