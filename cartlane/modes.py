"""Two readings of rules that were written one way and declared another.

``reference`` repeats what the original jobs compute; ``strict`` follows the table
definitions and column names. Each operator that has both readings takes ``mode``.
"""

REFERENCE = "reference"
STRICT = "strict"


def check_mode(mode: str) -> str:
    if mode not in (REFERENCE, STRICT):
        raise ValueError(f"mode must be {REFERENCE!r} or {STRICT!r}, not {mode!r}")
    return mode
