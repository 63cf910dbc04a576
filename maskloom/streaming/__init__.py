"""Row masking on streams."""
