"""Readers and writers with declared schemas (``io``: S1–S3, S6) and the
stand-in domain datasets built from the driver tables (``fixtures``)."""
