"""streaming of loquela."""
