"""Payload readers, stored tables, sinks and gap injection."""
