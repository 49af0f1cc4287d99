"""Width of the work: independent actions side by side, and shuffles as wide as their rows need."""

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Rows per shuffle partition.
PARTITION_ROWS = 2_000_000


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of all steps, in order. The first error is raised after all have ended.

    Steps that do not need each other run at the same time, so that the last tasks of one do not
    leave the cluster idle.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [future.result() for future in futures]


def in_order(spark: SparkSession, steps: dict[str, tuple[list[str], Callable[[], object]]]) -> dict[str, object]:
    """Results of all steps by name. Each has the names of those it needs and starts when these have ended.

    So a slow step holds back nothing but what needs it. The first error is raised after all steps have ended that
    do not need a failed one.
    """
    waiting, running, done, failed = dict(steps), {}, {}, {}
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        while waiting or running:
            for name in [n for n, (needs, _) in waiting.items() if all(x in done for x in needs)]:
                running[pool.submit(inheritable_thread_target(spark)(waiting.pop(name)[1]))] = name
            if not running:
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if future.exception() is None:
                    done[name] = future.result()
                else:
                    failed[name] = future.exception()
    for error in failed.values():
        raise error
    if waiting:
        raise ValueError(f"steps that need each other or something unknown: {', '.join(waiting)}")
    return done


def widen(spark: SparkSession, rows: int) -> None:
    """Raise the number of shuffle partitions of a session if `rows` need more than it has.

    Adaptive execution merges partitions that turn out small, but it cannot cut the ones of an
    aggregation, so too many cost little and too few spill.
    """
    needed = rows // PARTITION_ROWS
    if needed > int(spark.conf.get(SHUFFLE_PARTITIONS)):
        spark.conf.set(SHUFFLE_PARTITIONS, needed)
