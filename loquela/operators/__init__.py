"""operators of loquela."""
