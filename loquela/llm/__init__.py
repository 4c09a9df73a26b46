"""Operators for preparing training data; nothing else in loquela imports this subpackage."""
