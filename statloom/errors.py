"""What goes wrong with a statistical file."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator


class StatError(Exception):
    """A file that cannot be read or written."""


@contextlib.contextmanager
def told_by_executors() -> Iterator[None]:
    """Turns what a task has raised, or ``raise_error`` in a query, into ``StatError`` with the same words."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    try:
        yield
    except (Py4JJavaError, PySparkException) as e:
        text = str(e)
        found = re.search(r"statloom\.errors\.StatError: (.*)", text) or re.search(r"\[USER_RAISED_EXCEPTION\] (.*?)(?: SQLSTATE: \w+)?$", text, re.MULTILINE)
        if not found:
            raise
        raise StatError(found[1].strip()) from e


class StatWarning(UserWarning):
    """Something that was put right, or left out, while reading or writing."""
