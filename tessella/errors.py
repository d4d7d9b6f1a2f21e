"""Errors raised by the operators."""


class EmptyResultError(ValueError):
    """An operator left no rows, no columns or no shared ids."""


class NotUniqueError(ValueError):
    """Row ids repeat where an operator needs them to be unique."""
