"""The same steps on streams."""
