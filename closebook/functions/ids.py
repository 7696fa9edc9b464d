"""Contract id expressions.

An id reads ``<org>_<org>_<seg>_<portf>_<year>_<ON|NO>_<number>[/<n>]``; the
part after the first slash never counts. A missing segment gives NULL, other
missing parts give an empty text; neither is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from closebook.params import LIFE, NON_LIFE


def stem(ref: Column) -> Column:
    return F.substring_index(ref, "/", 1)


def _slice(ref: Column, start: int, count: int | None = None) -> Column:
    """Parts ``start`` to ``start + count`` (counted from 0), joined again.

    Plain byte scans: splitting into an array would run a regular expression
    and copy every part of every row.
    """
    head = F.length(F.substring_index(ref, "_", start))
    rest = F.substring(ref, head + 2, F.length(ref))
    return rest if count is None else F.substring_index(rest, "_", count)


def segment_part(base: Column) -> Column:
    """The third part of an id without its suffix; empty if it has none."""
    return _slice(base, 2, 1)


def tail(base: Column, count: int) -> Column:
    """The last ``count`` parts: 3 -> ``2021_NO_10260``, 2 -> ``NO_10260``."""
    return F.substring_index(base, "_", -count)


def _known(part: Column) -> Column:
    return F.nullif(part, F.lit(""))


# Contract keys from an id, its stem and its segment part. A caller that has the two as
# columns works them out once for all keys; see ``classify.derive_contract``.
CONTRACT_FORMS = {
    # Segment, then year, marker and number: LRH_2021_NO_10260.
    "segment": lambda ref, base, part: F.concat(part, F.lit("_"), _slice(base, 4, 3)),
    "tail3": lambda ref, base, part: tail(base, 3),
    "tail2": lambda ref, base, part: tail(base, 2),
    # Segment plus the last three parts.
    "segment_tail": lambda ref, base, part: F.concat(_known(part), F.lit("_"), tail(base, 3)),
    # Everything from the segment on (ids that carry no portfolio part).
    "from_segment": lambda ref, base, part: _slice(base, 2),
    # Four parts from the segment on; the slash is not treated specially.
    "portfolio": lambda ref, base, part: _slice(ref, 2, 4),
    "whole": lambda ref, base, part: ref,
}


def contract(ref: Column, form: str) -> Column:
    """The contract key of an id in one of the forms."""
    base = stem(ref)
    return CONTRACT_FORMS[form](ref, base, segment_part(base))


def life_of(part: Column) -> Column:
    return F.when(part.startswith("L"), F.lit(LIFE)).otherwise(F.lit(NON_LIFE))


def segment_of(part: Column) -> Column:
    return F.substring(_known(part), 2, 2)


def life_flag(ref: Column) -> Column:
    return life_of(segment_part(stem(ref)))


def segment(ref: Column) -> Column:
    return segment_of(segment_part(stem(ref)))


def onerous_marker(contract: Column) -> Column:
    """Marker inside a three-part contract key: ``2021_NO_10260`` -> ``NO``."""
    return F.nullif(_slice(contract, 1, 1), F.lit(""))
