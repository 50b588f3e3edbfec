"""Operators of a training-data pipeline. Nothing else in radspark imports this subpackage."""
