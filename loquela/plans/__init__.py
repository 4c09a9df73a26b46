"""plans of loquela."""
