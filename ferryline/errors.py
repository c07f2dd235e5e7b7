"""Exceptions raised by transfers."""

from __future__ import annotations


class TransferError(RuntimeError):
    """A transfer could not be completed; nothing was published."""


class RejectBudgetExceeded(TransferError):
    """The number of rejected rows reached ``max_errors``.

    ``summary`` holds the same figures a successful run would have returned.
    """

    def __init__(self, message: str, summary: dict):
        super().__init__(message)
        self.summary = summary


class NotATableError(TransferError):
    """Direct transfers work on real tables only, not on views or other objects."""
