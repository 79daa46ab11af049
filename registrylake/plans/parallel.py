"""Independent writes side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait


def run_all(writes: Iterable[Callable[[], None]], threads: int = 4) -> None:
    """Run all, in order of start; after a failure no other is started."""
    with ThreadPoolExecutor(threads) as pool:
        started = [pool.submit(write) for write in writes]
        done, _ = wait(started, return_when=FIRST_EXCEPTION)
        failed = next((f for f in started if f in done and f.exception()), None)
        if failed:
            pool.shutdown(wait=True, cancel_futures=True)
            raise failed.exception()
