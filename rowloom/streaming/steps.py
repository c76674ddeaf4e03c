"""Operators on a streaming Frame.

Row-wise operators are applied to the streaming DataFrame itself, so their filters and column
lists reach the file scan.  From the first operator that needs row positions on, the chain is
kept as steps that run on every micro-batch; a step carries the number of rows it has seen, so
positions continue from batch to batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import wraps
from typing import Any

from pyspark.sql import functions as F

from rowloom.frame import POS, Frame
from rowloom.plans.order import count_of, cut, number
from rowloom.streaming.mixing import Mixer

#: (micro-batch frame, rows seen so far) -> (result, rows seen afterwards)
Run = Callable[[Frame, int], tuple[Frame, int]]


@dataclass(frozen=True)
class Step:
    run: Run
    template: Frame  # empty bounded frame with the schema after this step
    limit: int | None = None  # rows after which the step lets nothing through
    mixer: Mixer | None = None  # the step keeps rows back; ``run`` is not used then

    @property
    def columns(self) -> list[str]:
        return self.template.columns


def template_of(frame: Frame) -> Frame:
    """Empty loaded frame with the schema at the end of a streaming chain."""
    if frame.steps:
        return frame.steps[-1].template
    empty = frame.spark.createDataFrame([], frame.df.schema)
    return Frame(empty, frame.order, "sorted")


def add_step(frame: Frame, run: Run, template: Frame | None = None, limit: int | None = None) -> Frame:
    step = Step(run, template or template_of(frame), limit)
    return replace(frame, steps=(*frame.steps, step))


def on_streams(stateful: Callable[[tuple[Any, ...]], bool] = lambda _: False) -> Callable[..., Any]:
    """Let an operator work on streaming frames.

    ``stateful`` tells from the arguments whether the operator adds a step itself.  A row-wise
    operator changes the streaming DataFrame, or joins the steps when there are some already.
    Either way it is also applied to the frame's lazy twin.
    """

    def decorate(operator: Callable[..., Frame]) -> Callable[..., Frame]:
        @wraps(operator)
        def apply(frame: Frame, *args: Any, **kwargs: Any) -> Frame:
            if not isinstance(frame, Frame) or frame.bounded:
                return operator(frame, *args, **kwargs)
            if frame.steps and not stateful((*args, *kwargs.values())):
                template = operator(template_of(frame), *args, **kwargs)  # checks the arguments
                out = add_step(frame, lambda batch, seen: (operator(batch, *args, **kwargs), seen), template)
            else:
                out = operator(frame, *args, **kwargs)
            twin = frame.twin
            return out if twin is None else replace(out, twin=lambda: operator(twin(), *args, **kwargs))

        return apply

    return decorate


def always(_: tuple[Any, ...]) -> bool:
    return True


def skip_step(frame: Frame, n: int) -> Frame:
    def run(batch: Frame, seen: int) -> tuple[Frame, int]:
        if seen >= n:
            return batch, seen
        return cut(batch, n - seen), seen + count_of(batch)

    return add_step(frame, run)


def take_step(frame: Frame, n: int) -> Frame:
    def run(batch: Frame, seen: int) -> tuple[Frame, int]:
        if seen >= n:
            return batch.filtered(F.lit(False)), seen
        piece = cut(batch, 0, n - seen)
        return piece, seen + count_of(piece)

    return add_step(frame, run, limit=n)


def index_step(frame: Frame, target: str, put_column: Callable[..., Frame]) -> Frame:
    def run(batch: Frame, seen: int) -> tuple[Frame, int]:
        numbered = number(batch)
        return put_column(numbered, target, F.col(POS) + F.lit(seen)), seen + count_of(batch)

    template = put_column(template_of(frame), target, F.lit(0).cast("bigint"))
    return add_step(frame, run, template)


def shuffle_step(frame: Frame, mixer: Mixer) -> Frame:
    """Bounded-buffer shuffle, whose buffer is carried from batch to batch."""
    step = Step(lambda batch, seen: (batch, seen), template_of(frame), mixer=mixer)
    return replace(frame, steps=(*frame.steps, step))
