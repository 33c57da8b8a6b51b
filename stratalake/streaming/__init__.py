from .declared import Declared, run_declared
from .merged import expired_parts, run_merged
from .runs import run_complete, run_once
from .windows import (
    closed_sliding_distinct,
    pane_sketches,
    sliding_distinct,
    tumbling_distinct,
    windows_from_panes,
)

__all__ = [
    "Declared",
    "closed_sliding_distinct",
    "expired_parts",
    "pane_sketches",
    "run_complete",
    "run_declared",
    "run_merged",
    "run_once",
    "sliding_distinct",
    "tumbling_distinct",
    "windows_from_panes",
]
