"""Operators for preparing training data; one module per operator, named queries in ``queries``."""
