"""Errors that callers can tell apart.

Where a builtin exception says it exactly (a missing or existing dataset, a wrong argument, IO, an
unsupported feature) that is raised; the rest is :class:`EngineError`. Wrong arguments stay outside
the ``EngineError`` tree.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException, PythonException


class EngineError(RuntimeError):
    """A failure that no builtin exception describes."""


class CommitConflictError(EngineError):
    """Another writer committed first; reading the dataset anew and writing again may succeed."""


def translated(error: Exception) -> Exception:
    """The exception that a caller gets for one of Spark's."""
    text = str(error)
    name = error.getCondition() or "" if isinstance(error, PySparkException) else ""
    if isinstance(error, PythonException):  # the caller's own function failed
        return EngineError(text)
    if isinstance(error, AnalysisException):
        if "PATH_NOT_FOUND" in name:
            return FileNotFoundError(text)
        if "PATH_ALREADY_EXISTS" in name:
            return FileExistsError(text)
        if name.startswith("UNSUPPORTED"):
            return NotImplementedError(text)
        return error  # the host engine's own, as it is
    if isinstance(error, Py4JJavaError):
        kind = error.java_exception.getClass().getName()
        if "TimeoutException" in kind:
            return TimeoutError(text)
        if "FileAlreadyExists" in kind:
            return FileExistsError(text)
        if "IOException" in kind or "FileNotFound" in kind or "AccessDenied" in kind:
            return OSError(text)
        return EngineError(text)
    if isinstance(error, PySparkException):
        return NotImplementedError(text) if name.startswith("UNSUPPORTED") else EngineError(text)
    return error


@contextlib.contextmanager
def translating() -> Iterator[None]:
    """Within it, Spark's exceptions leave as the engine's."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as e:
        new = translated(e)
        if new is e:
            raise
        raise new from e
