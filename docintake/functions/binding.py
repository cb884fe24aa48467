"""Evaluating a shared part of an expression once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(body: Callable[[Column], Column], **parts: Column) -> Column:
    """``body`` of a struct of ``parts``, each of which is computed once.

    Without it every use of a part inside ``body`` is a copy of its whole expression.
    """
    values = F.array(F.struct(*[c.alias(name) for name, c in parts.items()]))
    return F.get(F.transform(values, body), F.lit(0))
