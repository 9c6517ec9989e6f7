"""Errors of the sinks."""


class SinkError(RuntimeError):
    pass
