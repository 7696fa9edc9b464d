"""Quarter-close insurance accounting on Spark DataFrames.

Every function takes and returns lazy DataFrames; nothing here collects rows
or runs Python per row.
"""

from closebook.params import CloseParams

__all__ = ["CloseParams"]
