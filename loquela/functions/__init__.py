"""functions of loquela."""
