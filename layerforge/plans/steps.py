"""Independent steps of a load, submitted to Spark side by side."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from layerforge.session import free_shuffles

# Small tables of a layer do not keep a cluster busy one after the other. Every step at
# work has plans, compiled code and broadcasts of its own in the driver: two of them do.
STEPS_AT_ONCE = 2
FREE_EVERY = 1.0  # seconds; steps of small tables share a request to let go of what is done


def side_by_side(
    names: Iterable[str], step: Callable[[str], DataFrame]
) -> dict[str, DataFrame]:
    """``step(name)`` for every name; the first error is raised after all have ended.

    Shuffle files, broadcasts and plans of a step go when it is done, not with the
    last step: disks and the driver hold those of the steps at work.
    """
    names = list(names)
    asked, turn = time.monotonic(), threading.Lock()

    def run(name: str) -> DataFrame:
        nonlocal asked
        rows = step(name)
        with turn:
            if time.monotonic() - asked >= FREE_EVERY:
                free_shuffles(rows.sparkSession)
                asked = time.monotonic()
        return rows

    with ThreadPoolExecutor(max_workers=STEPS_AT_ONCE) as pool:
        done = dict(zip(names, pool.map(run, names), strict=True))
    for rows in list(done.values())[:1]:
        free_shuffles(rows.sparkSession)  # of all steps at once
    return done
