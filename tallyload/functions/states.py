"""B6 state_decode: ledger state codes, names and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Task state codes, and the message used when a ledger row has
# no state text (indexed by state).
NEW, OPERATING, ERROR, SUCCESSFUL = 0, 1, 2, 3
STATE_NAMES = ["NEW", "OPERATING", "ERROR", "SUCCESSFUL"]
STATE_DEFAULT_INFO = [
    "new task",
    "task operation in progress",
    "task exec error",
    "task exec sussessful",
]
FINISHED = (ERROR, SUCCESSFUL)
#: Message of a task that stays NEW because its event type is not registered (yet).
WAITING = "unregistered event type"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def state_code(state) -> Column:
    """Known codes pass through; anything else (or NULL) reads as ERROR."""
    s = _col(state)
    return F.when(s.isin(NEW, OPERATING, ERROR, SUCCESSFUL), s).otherwise(F.lit(ERROR)).cast("int")


def state_name(state) -> Column:
    s = state_code(state)
    return F.element_at(F.array(*[F.lit(n) for n in STATE_NAMES]), s + 1)


def state_text(state, info) -> Column:
    s = state_code(state)
    default = F.element_at(F.array(*[F.lit(n) for n in STATE_DEFAULT_INFO]), s + 1)
    return F.coalesce(_col(info), default)
