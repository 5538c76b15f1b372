"""Relational operators over observation and weather frames."""
