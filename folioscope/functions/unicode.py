"""Unicode compatibility forms, which Spark has no function for."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column

from folioscope.functions.by_row import by_row

_INVISIBLE = re.compile("[​‌‍⁠﻿­]")


def compatible(text: Column) -> Column:
    """NFKC without invisible characters; null stays null. ASCII texts are their own form."""
    return by_row(lambda t: t if t is None or t.isascii() else _INVISIBLE.sub("", unicodedata.normalize("NFKC", t)))(text)
