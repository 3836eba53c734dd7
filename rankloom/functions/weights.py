"""Event label -> implicit-feedback weight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's recoding): view=1, addtocart=2, transaction=3.
EVENT_WEIGHTS = {"view": 1.0, "addtocart": 2.0, "transaction": 3.0}

ON_UNKNOWN = ("error", "null", "drop")


def weight_expr(col: str | Column = "event", on_unknown: str = "error") -> Column:
    """CASE expression mapping an event label to a DOUBLE weight.

    Scoped to one column (a dict ``replace`` without ``subset`` would rewrite every
    string column).  ``on_unknown``: ``error`` raises on an unmapped label, ``null``
    and ``drop`` give NULL (``drop`` is applied as a filter by the caller).
    """
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for label, w in EVENT_WEIGHTS.items():
        expr = (F.when(c == label, F.lit(w)) if expr is None
                else expr.when(c == label, F.lit(w)))
    if on_unknown == "error":
        unknown = F.raise_error(F.concat(F.lit("unknown event label: "), c.cast("string")))
        expr = expr.when(c.isNull(), F.lit(None).cast("double")).otherwise(unknown.cast("double"))
    return expr.cast("double")


def recode_expr(col: str | Column = "event") -> Column:
    """The label's weight as text ('1', '2', '3'); an unknown label stays as it is, which is
    what a dictionary replacement of the column does."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for label, w in EVENT_WEIGHTS.items():
        text = F.lit(str(int(w)))
        expr = F.when(c == label, text) if expr is None else expr.when(c == label, text)
    return expr.otherwise(c.cast("string"))
