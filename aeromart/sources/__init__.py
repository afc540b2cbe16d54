"""Payload readers and the tables that loads write to."""
