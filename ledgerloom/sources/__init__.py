"""Readers for landing files, layer tables and message topics."""
