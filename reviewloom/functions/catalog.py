"""Product category guessed from the item id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first matching prefix decides.
CATEGORY_BY_PREFIX = (
    ("B09", "Electronics"),
    ("B08", "Electronics"),
    ("B07", "Electronics"),
    ("B01", "Gadgets & Accessories"),
    ("B00", "Home & Kitchen"),
    ("B0", "Electronics"),
    ("19", "Books — Non-Fiction"),
    ("05", "Books — Reference"),
    ("03", "Books — Fiction"),
    ("0", "Books"),
    ("1", "Books"),
)
OTHER_CATEGORY = "General"


def category_of(item: Column | str) -> Column:
    value = F.col(item) if isinstance(item, str) else item
    first, *rest = CATEGORY_BY_PREFIX
    start = F.when(value.startswith(first[0]), first[1])
    chain = reduce(lambda acc, pair: acc.when(value.startswith(pair[0]), pair[1]), rest, start)
    return chain.otherwise(OTHER_CATEGORY)
