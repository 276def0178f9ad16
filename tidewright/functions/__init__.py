"""Column builders: JSON text, time bounds, text, bands, hash vectors."""
