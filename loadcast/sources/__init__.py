"""Readers and writers: tables, CSV, landing directories, JSON/XML payloads."""
