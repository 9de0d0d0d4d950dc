"""Fixed parameters that the Spark and the SQL side share."""

from __future__ import annotations

from gridtally.operators.casting import STORED_TYPES
from gridtally.schemas import SUBENTRY_BUCKETS

__all__ = [
    "FROM", "ITEM", "KEY_FROM", "KEY_SHIFT", "KEY_TO", "MEDIA", "NESTED", "NOW", "PER_BATCH", "POINT", "QUEUE_STAMP",
    "SPLIT", "STORED_TYPES", "SUBENTRY_BUCKETS", "SUBENTRY_CODES", "TO", "UNKNOWN_CODE", "VIRTUALS",
]

NOW = "2024-02-01 00:00:00"
SPLIT = "2024-01-15 12:30:00"
FROM, TO = "2024-01-10 00:00:00", "2024-01-20 12:00:00"
POINT = "2024-01-23 16:00:00"
ITEM = "B0_G0_M0"
QUEUE_STAMP = "2024012006"
KEY_FROM, KEY_TO = "Customer#000000100", "Customer#000001200"
KEY_SHIFT = 750

MEDIA = [  # event type, type id, code, basic code, table
    ("click", 11, "01-1", "A", "elec"),
    ("view", 12, "02-1", "B", "other"),
    ("purchase", 13, "03-1", "C", "other"),
    ("signup", 14, "04-1", None, "other"),
]
UNKNOWN_CODE = "99-9"
SUBENTRY_CODES = ["0101", "01A1", "01B1", "01C1", "01D1", "01E1"]
VIRTUALS = [  # id, code, data type, max value, sub-entry, formula
    (2001, "V1", 11, 100.0, 2, "1000 + 1004 - d5 * ( 2 )"),
    (2002, "V2", 11, None, None, "( 1000 - 1004 ) / d0"),
    (2003, "V3", 12, None, None, "1001 + 1005"),
    (2004, "V4", 11, None, None, "9999 + d1"),
    (2005, "V5", 11, None, None, "( 1000 + 1004 ) / d0.5 - d1"),
]
NESTED = [  # id, code, collector, data type, max value, formula
    (2101, "N1", 1, 11, None, "1000 + 1004"),
    (2102, "N2", 1, 11, 150.0, "2101 * d2 - 1004"),
    (2103, "N3", 2, 11, None, "2102 + 2101 * d3 + 1008"),  # third level, another building
    (2104, "N4", 1, 11, None, "2105 + d1"),  # a cycle of two
    (2105, "N5", 1, 11, None, "2104 + 1000"),
    (2106, "N6", 1, 11, None, "2106 + 1000"),  # reads itself
    (2107, "N7", 1, 11, None, "2105 + 1000 * d3"),  # reads a cycle's member
    (2108, "N8", 1, 11, None, "2104 + 2106"),  # reads nothing else
    (2109, "N9", 1, 12, None, "1001 + 2101"),  # an input of the other side
    (2110, "N10", 1, 11, None, "2107 + 2103"),
]
# The same formulas as sums: id, input, factor; and the constants added.
NESTED_TERMS = [
    (2101, 1000, 1), (2101, 1004, 1), (2102, 2101, 2), (2102, 1004, -1),
    (2103, 2102, 1), (2103, 2101, 3), (2103, 1008, 1), (2104, 2105, 1), (2105, 2104, 1),
    (2105, 1000, 1), (2106, 2106, 1), (2106, 1000, 1), (2107, 2105, 1), (2107, 1000, 3),
    (2108, 2104, 1), (2108, 2106, 1), (2109, 1001, 1), (2109, 2101, 1), (2110, 2107, 1),
    (2110, 2103, 1),
]
NESTED_ADDED = [(2104, 1)]
NESTED_LEVELS = 4
PER_BATCH = 50
# Partition 3 is not recorded, partition 2 from its start; offset 1 has aged out of any log here.
VALID_OFFSETS = [(0, 1_000_000_000), (1, 40), (2, 0)]
AGED_OFFSETS = [(0, 1_000_000_000), (1, 1), (2, 0)]
CUSTOMERS = [1, 7, 44, 100, 1_000_000_000]
CUSTOMER_RANGE = (60, 75)
