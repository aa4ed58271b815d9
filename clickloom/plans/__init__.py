from clickloom.plans.hotkeys import (
    HOT_ROWS,
    SPAN,
    hot_keys,
    payload_bytes,
    small_or_shuffled,
)
from clickloom.plans.staging import delete_folder, release_staged, stage, staging_root

__all__ = [
    "HOT_ROWS",
    "SPAN",
    "delete_folder",
    "hot_keys",
    "payload_bytes",
    "release_staged",
    "small_or_shuffled",
    "stage",
    "staging_root",
]
