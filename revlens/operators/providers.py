"""The one place rows leave the JVM: calls to translators, judges, summarizers."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from threading import local
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

_ARROW = {"string": pa.string(), "double": pa.float64()}
#: Rows of an Arrow batch whose calls and answers are Python objects at the same time.
_SLICE = 64

#: Value, name of the error.
Result = tuple[Any, str | None]


@dataclass(frozen=True)
class Calls:
    """How plain Python is called: attempts, waits and how many at a time.

    A call that raises one of ``retry_on`` is made again, ``attempts`` times in all, after
    ``wait`` seconds that grow by the factor ``backoff``. No attempt begins later than
    ``deadline`` seconds after the first one; one under way is not cut off, so a limit on
    a single attempt is the client's to keep. ``in_flight`` calls of a task run at the
    same time, each thread with a function of its own from the factory. ``tasks``, if
    given, is how many tasks call side by side, so ``tasks * in_flight`` is the load
    that the service sees, whatever the cluster's size; it deals the rows out anew.
    """

    attempts: int = 1
    wait: float = 2.0
    backoff: float = 2.0
    deadline: float | None = None
    in_flight: int = 1
    tasks: int | None = None
    retry_on: tuple[type[Exception], ...] = (Exception,)

    def __post_init__(self):
        if self.attempts < 1 or self.in_flight < 1 or (self.tasks is not None and self.tasks < 1):
            raise ValueError("attempts, in_flight and tasks must be at least 1")
        if self.wait < 0 or self.backoff < 1 or (self.deadline is not None and self.deadline < 0):
            raise ValueError("wait and deadline must not be negative, backoff not below 1")

    def again(self, function: Callable[..., Any], call: tuple) -> Result:
        """The value, or the name of the last error."""
        began, pause = time.monotonic(), self.wait
        for attempt in range(1, self.attempts + 1):
            try:
                return function(*call), None
            except Exception as failure:  # a failed call is a row, not a failed task
                late = self.deadline is not None and time.monotonic() - began + pause > self.deadline
                if attempt == self.attempts or late or not isinstance(failure, self.retry_on):
                    return None, type(failure).__name__
            time.sleep(pause)
            pause *= self.backoff
        raise AssertionError("every attempt returns or raises")


@dataclass(frozen=True)
class Provider:
    """An injected function, as plain Python or as a column expression.

    ``batch`` takes a factory; the function it makes is called once per item
    inside an Arrow UDF and may raise; ``calls`` says how often it is tried again and how
    many calls run at a time. ``native`` takes a function from columns to a column whose
    null result means the call failed. ``version`` names what answers, model and settings
    included, for answers that are kept between runs (``operators.memory``).
    """

    make: Callable[[], Callable[..., Any]] | None = None
    column: Callable[..., Column] | None = None
    calls: Calls = Calls()
    version: str | None = None

    @classmethod
    def batch(
        cls, make: Callable[[], Callable[..., Any]], calls: Calls = Calls(), version: str | None = None
    ) -> Provider:
        return cls(make=make, calls=calls, version=version)

    @classmethod
    def native(cls, column: Callable[..., Column], version: str | None = None) -> Provider:
        return cls(column=column, version=version)

    @property
    def is_native(self) -> bool:
        return self.column is not None


@dataclass(frozen=True)
class Judge:
    """A provider of scores. ``replies`` marks one that is given the judge prompt
    and answers in words; its reply is parsed and clamped. A numeric score is
    taken as it is."""

    provider: Provider
    replies: bool = False


def call_each(
    df: DataFrame,
    provider: Provider,
    calls: Column,
    args: list[str],
    out: str,
    kind: str,
    together: int = 1,
) -> DataFrame:
    """Adds ``out``: one ``struct<value, error>`` per element of ``calls``.

    ``calls`` is an array of structs with the fields ``args``. Results stay in
    the row they were asked for, so enrichment never shuffles and never needs a
    regrouping step; the error is the name of the exception class. Only the calls
    cross into Python, the other columns stay where they are.

    Each ``together`` calls in a row belong together: after one that failed, plain
    Python is not asked for the rest of them and they are ``NotAsked``.
    """
    ddl = f"array<struct<value:{kind},error:string>>"
    if provider.is_native:

        values = F.transform(
            calls, lambda call: provider.column(*[call[a] for a in args]).cast(kind)
        )
        results = F.transform(
            values,
            lambda v: F.struct(v.alias("value"), F.when(v.isNull(), F.lit("NoReply")).alias("error")),
        )
        return df.withColumn(out, results.cast(ddl))

    make, policy, value_type = provider.make, provider.calls, _ARROW[kind]

    def answer(function: Callable[..., Any], call: tuple) -> Result:
        value, error = policy.again(function, call)
        if error is None and value is None:
            error = "NoReply"
        if error is None and kind == "string" and not isinstance(value, str):
            error = "TypeError"
        if error is None and kind == "double":
            try:
                value = float(value)
            except (TypeError, ValueError) as failure:
                error = type(failure).__name__
        return (None if error else value), error

    def answers(function: Callable[..., Any], asked: list[tuple]) -> list[Result]:
        """The calls of one group, one after the other."""
        results, failed = [], False
        for call in asked:
            result = (None, "NotAsked") if failed else answer(function, call)
            failed = failed or result[1] is not None
            results.append(result)
        return results

    def groups(lists: pa.ListArray, bounds: list[int]) -> Iterator[list[tuple]]:
        # The calls of all rows side by side, one array per argument.
        columns = lists.flatten().flatten()
        for start, end in zip(bounds, bounds[1:]):
            for at in range(start, end, together):
                size = min(together, end - at)
                yield list(zip(*[c.slice(at, size).to_pylist() for c in columns]))

    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with _Workers(make, policy.in_flight) as workers:
            for batch in batches:
                for at in range(0, len(batch), _SLICE):
                    lists = batch.slice(at, _SLICE)
                    sizes = pc.fill_null(pc.list_value_length(lists).cast(pa.int32()), 0)
                    ends = pc.cumulative_sum(pa.concat_arrays([pa.array([0], sizes.type), sizes]))
                    results = [
                        r for group in workers.map(answers, groups(lists, ends.to_pylist())) for r in group
                    ]
                    found = pa.StructArray.from_arrays(
                        [
                            pa.array([value for value, _ in results], value_type),
                            pa.array([error for _, error in results], pa.string()),
                        ],
                        names=["value", "error"],
                    )
                    yield pa.ListArray.from_arrays(ends, found)

    # The hints are set here, as the module's own are text.
    ask.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Nondeterministic, so that no rewrite of the plan repeats or moves the calls.
    asked = F.arrow_udf(ask, ddl).asNondeterministic()
    dealt = df.repartition(policy.tasks) if policy.tasks else df
    return dealt.withColumn("_calls", calls).withColumn(out, asked("_calls")).drop("_calls")


class _Workers:
    """Threads of one task that answer groups of calls; the caller gets them in order.

    Each thread makes its function when it first has work, so a task without calls builds
    no client. At most twice as many groups as threads are taken ahead of the answers.
    """

    def __init__(self, make: Callable[[], Callable[..., Any]], threads: int):
        self._make, self._threads = make, threads
        self._own = local()
        self._pool = ThreadPoolExecutor(threads) if threads > 1 else None

    def __enter__(self) -> _Workers:
        return self

    def __exit__(self, *raised) -> None:
        if self._pool is not None:
            # A task that is killed or fails does not start the calls still waiting.
            self._pool.shutdown(cancel_futures=True)

    def _run(self, work: Callable[[Callable[..., Any], Any], Any], item: Any) -> Any:
        if not hasattr(self._own, "function"):
            self._own.function = self._make()
        return work(self._own.function, item)

    def map(self, work: Callable[[Callable[..., Any], Any], Any], items: Iterator[Any]) -> Iterator[Any]:
        if self._pool is None:
            yield from (self._run(work, item) for item in items)
            return
        waiting: deque[Future] = deque()
        for item in items:
            waiting.append(self._pool.submit(self._run, work, item))
            if len(waiting) >= 2 * self._threads:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def echo_translator() -> Provider:
    """Offline translator: the text behind a tag of its target language."""
    return Provider.native(
        lambda text, source, target: F.concat(F.lit("["), target, F.lit("] "), text)
    )


def fixed_judge(score: float) -> Judge:
    """Offline judge: the same score for every translation."""
    return Judge(Provider.native(lambda *_: F.lit(float(score))))
