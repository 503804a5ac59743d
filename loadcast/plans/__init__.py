"""User-level jobs composed from ``loadcast.operators``."""
