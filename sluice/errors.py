"""Errors raised by the loader."""


class LoadPlanError(ValueError):
    """The load cannot be planned: bad mapping, type or settings. No job has started."""


class LoadAborted(RuntimeError):
    """A row was rejected while ``abort_on_error`` was set. Nothing was published."""

    def __init__(self, message, reason=None):
        super().__init__(message)
        self.reason = reason
