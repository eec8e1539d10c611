"""What a Python worker keeps from one task to the next.

Workers outlive stages. Were each operator to keep its tables of words there,
a job of several operators would hold all of them in every worker.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}


def kept(kind: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returned when this worker first asked for ``kind``. Asking for another kind lets go of it."""
    if kind not in _kept:
        _kept.clear()
        gc.collect()  # some refer to themselves
        _kept[kind] = make()
    return _kept[kind]
