"""Column helpers: tolerant casts, calendar arithmetic, bands, masking."""
