"""Readers and writers of landed files, refined tables and topics."""
