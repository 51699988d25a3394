"""Python functions of one text as column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_row(f: Callable, returns: str = "string") -> Callable[[Column], Column]:
    """f of each row's text, null included. Rows go to Python and back 100 at a time, so a worker holds some texts and not an Arrow
    batch of 10,000 of them with all their results, however many rows a task has.
    """
    return lambda text: F.udf(f, returns, useArrow=False)(text)  # made when it is used, as it needs a session
