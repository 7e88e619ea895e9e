"""Operators of a training-data pipeline over web text; nothing else in the library imports this subpackage."""
