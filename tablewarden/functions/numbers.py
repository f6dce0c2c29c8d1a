"""SQL expressions on numbers."""
from __future__ import annotations

import math


def double(x: float) -> str:
    """A double as SQL, also where it is infinite or not a number."""
    if math.isnan(x):
        return "double('NaN')"
    if math.isinf(x):
        return "double('Infinity')" if x > 0 else "double('-Infinity')"
    return f"{float(x)!r}D"


def half_up(value: str, places: int) -> str:
    """Rounded half up. Digits beyond the tenth are floating-point noise and go
    first, so that 97.575 computed as 97.57499999999999 still counts as a tie."""
    return f"round(round({value}, 10), {places})"
