from millrace.functions.items import (
    OpenPart,
    attribute,
    condition,
    epoch_micros,
    has_attribute,
    merge_streams,
    put,
    rows_within,
    with_attributes,
)

__all__ = [
    "OpenPart",
    "attribute",
    "condition",
    "epoch_micros",
    "has_attribute",
    "merge_streams",
    "put",
    "rows_within",
    "with_attributes",
]
