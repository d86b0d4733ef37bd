"""Tag jobs end to end."""
