"""Enum numbers and names as literal maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalstats.model import CALL_STATE_ORDINALS, ENUMS


def _lookup(table: dict, key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def enum_name(enum: str, number: Column) -> Column:
    """Name of an enum value, NULL when the number is not in the enumeration."""
    return _lookup(ENUMS[enum], number.cast("int"))


def enum_number(enum: str, name: Column) -> Column:
    """Number of an enum name, NULL when the name is not in the enumeration."""
    return _lookup({name: number for number, name in ENUMS[enum].items()}, name)


def call_state_for(ordinal: Column) -> Column:
    """Call state of the short four-value numbering, NULL when unknown."""
    return _lookup(CALL_STATE_ORDINALS, ordinal.cast("int"))
