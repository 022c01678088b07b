"""Operators for preparing training data: one module per operator, ``queries``
holding what is registered.  Nothing else in the library imports this package."""
