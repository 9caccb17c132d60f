from keyweave.functions.keys import (
    composite_key,
    full_name,
    index_key,
    is_linked,
    number,
    search_key,
    try_number,
)
from keyweave.functions.sparse import attribute_count, drop_empty, with_defaults

__all__ = [
    "attribute_count",
    "composite_key",
    "drop_empty",
    "full_name",
    "index_key",
    "is_linked",
    "number",
    "search_key",
    "try_number",
    "with_defaults",
]
