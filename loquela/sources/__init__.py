"""sources of loquela."""
