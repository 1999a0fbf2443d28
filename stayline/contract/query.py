"""A named query: Spark side, SQL side, and one column spec that both are cast by."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from stayline.contract.views import VIEWS
from stayline.sources.inputs import Inputs

_KINDS = {"s": ("string", "varchar"), "i": ("bigint", "bigint"), "d": ("double", "double")}


def _rounded(value: str, digits: str) -> str:
    """Rounding both engines agree on: a nudge far below the last digit moves exact ties
    (which one engine would round up and the other down) off the boundary."""
    return f"round({value} + 3e-{int(digits) + 2}, {digits})"


def _parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


@dataclass(frozen=True)
class Query:
    """``spec`` lists ``column:kind``; kinds are s(tring), i(nteger), d(ouble), rN (rounded double)."""

    run: Callable[[Inputs], DataFrame]
    spec: str
    sql: str | None = None

    def frame(self, inputs: Inputs) -> DataFrame:
        df = self.run(inputs)
        cols = []
        for name, kind in _parse(self.spec):
            if kind.startswith("r"):
                # Adding zero turns a rounded -0.0 into 0.0.
                cols.append(f"{_rounded(f'cast(`{name}` as double)', kind[1:])} + 0D as `{name}`")
            else:
                cols.append(f"cast(`{name}` as {_KINDS[kind][0]}) as `{name}`")
        return df.selectExpr(*cols)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = []
        for name, kind in _parse(self.spec):
            if kind.startswith("r"):
                cols.append(_rounded(f'cast("{name}" as double)', kind[1:]) + f' + 0.0 as "{name}"')
            else:
                cols.append(f'cast("{name}" as {_KINDS[kind][1]}) as "{name}"')
        return f"{with_views(self.sql)} select {', '.join(cols)} from result"


def with_views(body: str) -> str:
    """``WITH`` clause of every view the body needs, in dependency order, plus ``result``."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|v)_\w+\b", text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(body)
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in order] + [f"result as ({body.strip()})"]
    return "with " + ",\n".join(parts)
