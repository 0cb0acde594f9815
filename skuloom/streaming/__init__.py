"""Reports on streams."""
