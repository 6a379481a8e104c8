"""Row windows over long series: fixed-size row blocks that share a margin.

Every row gets its position in the series. Blocks of ``rows`` consecutive positions are windowed
independently; the last ``margin`` rows of a block are also handed to the next block, so that a
frame reaching back at most ``margin`` rows sees exactly the rows it would see in the whole
series. Margin copies are dropped at the end. No task ever holds more than one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tideframe.functions.expressions import finite, project
from tideframe.plans.ordered import Carry, Series, filled_value, forward_fill, last_known, with_carry

SEGMENT_ROWS = 512
NEGLIGIBLE = 1e-18
BLOCK_ROWS = 16 * SEGMENT_ROWS

POSITION, BLOCK, SEGMENT, START = "__position", "__block", "__segment", "__start"


def segment_column(rows: int) -> str:
    return SEGMENT if rows == SEGMENT_ROWS else f"{SEGMENT}{rows}"


@dataclass
class Columns:
    """Feature columns gathered in dependency order, as Spark SQL text.

    A primitive (lag, rolling statistic, ...) asked for twice is computed once. Columns of the same
    depth go into one projection, so Spark evaluates them with one sort and few Window nodes.
    Every method returns an expression over the gathered columns.
    """

    series: Series
    available: list[str]
    depth: dict[str, int] = field(default_factory=dict)
    steps: list[dict[str, str]] = field(default_factory=list)
    lookback: int = 0
    segments: set[int] = field(default_factory=set)
    carried: list[str] = field(default_factory=list)

    def over(self, frame: str = "") -> str:
        return f"OVER (PARTITION BY {', '.join([*self.series.keys, BLOCK])} ORDER BY {SEGMENT}, {POSITION} {frame})"

    def add(self, name: str, expr: str, needs: list[str]) -> str:
        """Register a column that depends on the columns ``needs``; returns its name."""
        if name not in self.depth:
            level = max([self.depth.get(n, 0) for n in needs], default=0)
            while len(self.steps) <= level:
                self.steps.append({})
            self.steps[level][name] = expr
            self.depth[name] = level + 1
        return name

    def lag(self, c: str, k: int) -> str:
        self.lookback = max(self.lookback, k)
        return self.add(f"__lag{k}_{c}", f"lag({c}, {k}) {self.over()}", [c])

    def filled(self, c: str) -> str:
        """Forward-filled version of ``c``; the column itself if the frame has no gaps."""
        name = f"__ffill_{c}"
        return name if name in self.available else c

    def filled_lag(self, c: str, k: int) -> str:
        return self.lag(self.filled(c), k)

    def _rolling(self, function: str, c: str, rows: int) -> str:
        """Aggregate over the last ``rows`` rows; NULL unless all of them hold a finite value."""
        self.lookback = max(self.lookback, rows - 1)
        x = self.add(f"__fin_{c}", finite(c), [c])
        frame = self.over(f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW")
        n = self.add(f"__n{rows}_{c}", f"count({x}) {frame}", [x])
        value = self.add(f"__{function}{rows}_{c}", f"{function}({x}) {frame}", [x])
        return f"CASE WHEN {n} = {rows} THEN {value} END"

    def mean(self, c: str, rows: int) -> str:
        return self._rolling("avg", c, rows)

    def std(self, c: str, rows: int) -> str:
        return self._rolling("stddev_samp", c, rows)

    def low(self, c: str, rows: int) -> str:
        return self._rolling("min", c, rows)

    def high(self, c: str, rows: int) -> str:
        return self._rolling("max", c, rows)

    def correlation(self, a: str, b: str, rows: int) -> str:
        """Rolling Pearson correlation; NULL where either side does not vary."""
        self.lookback = max(self.lookback, rows - 1)
        x, y = (self.add(f"__fin_{c}", finite(c), [c]) for c in (a, b))
        frame = self.over(f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW")
        both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
        u, v = f"CASE WHEN {both} THEN {x} END", f"CASE WHEN {both} THEN {y} END"
        tag = f"{rows}_{a}_{b}"
        n = self.add(f"__npair{tag}", f"count({u}) {frame}", [x, y])
        cov = self.add(f"__cov{tag}", f"covar_samp({u}, {v}) {frame}", [x, y])
        spread = [self.add(f"__s{i}pair{tag}", f"stddev_samp({e}) {frame}", [x, y]) for i, e in enumerate((u, v))]
        return f"CASE WHEN {n} = {rows} THEN try_divide({cov}, {spread[0]} * {spread[1]}) END"

    def ewma(self, c: str, span: float) -> str:
        """Adjusted exponential mean: decayed sum of values over decayed sum of weights; NULL where ``c`` is.

        Inside a segment both sums are plain running sums of ``x / q^i``; the segment before enters
        as its closing sum times ``q^(i+1)``. A segment is so long that what is older weighs less than
        1e-18 of the row's own value. A row without a value repeats the mean of the last row that has one:
        name the output in ``carried`` to have that filled over gaps of any length.
        """
        q = 1.0 - 2.0 / (span + 1.0)
        if q < 0:
            raise ValueError(f"span {span} is below 1")
        if q == 0.0:
            return c
        needed = math.log(NEGLIGIBLE) / math.log(q)
        if q ** (SEGMENT_ROWS - 1) < 1e-290:  # decays so fast that a few rows are all of it
            terms = [(f"coalesce({self.lag(c, k) if k else c}, 0D)", f"CASE WHEN {self.lag(c, k) if k else c} IS NOT NULL THEN 1D ELSE 0D END", q**k) for k in range(math.ceil(needed))]
            top, low = (" + ".join(f"{w!r}D * {t[i]}" for t in terms for w in [t[2]]) for i in (0, 1))
            return f"CASE WHEN {c} IS NOT NULL THEN ({top}) / ({low}) END"
        rows = SEGMENT_ROWS
        while rows < needed:
            rows *= 2
        self.segments.add(rows)
        segment = segment_column(rows)
        keys = ", ".join([*self.series.keys, BLOCK])
        inside = f"OVER (PARTITION BY {keys}, {segment} ORDER BY {POSITION} ROWS UNBOUNDED PRECEDING)"
        before = f"OVER (PARTITION BY {keys} ORDER BY {segment} RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
        offset = f"({POSITION} % {rows})"
        decay = f"pow({q!r}D, {offset})"
        tag = str(span).replace(".", "_")
        parts = []
        for label, term in (("top", c), ("low", f"CASE WHEN {c} IS NOT NULL THEN 1D END")):
            local = self.add(f"__{label}{tag}_{c}", f"{decay} * coalesce(sum({term} / {decay}) {inside}, 0D)", [c])
            closing = f"sum(CASE WHEN {offset} = {rows - 1} THEN {local} END) {before}"
            carried = self.add(f"__carried{local}", closing, [local])
            parts.append(f"({local} + {decay} * {q!r}D * coalesce({carried}, 0D))")
        return f"CASE WHEN {c} IS NOT NULL THEN try_divide({parts[0]}, {parts[1]}) END"


def block_frame(
    df: DataFrame,
    series: Series,
    margin: int,
    rows: int = BLOCK_ROWS,
    fill: Sequence[str] = (),
    clean: Sequence[str] = (),
    segments: Sequence[int] = (),
) -> DataFrame:
    """Add position, block and segment columns (``segments``: further segment lengths) and the margin copies.

    ``fill`` adds ``__ffill_<c>`` columns. ``clean`` instead forward-fills the named columns in place
    and blanks the leading rows that still miss one of them, in the same pass that numbers the rows.
    """
    longest = max([SEGMENT_ROWS, *segments])
    rows = max(rows, margin, longest)
    rows += -rows % longest
    carries = [Carry("__before", "count(1)")]
    carries += [last_known(f"__last_{c}", c, series.time) for c in [*fill, *clean]]
    # the series starts with its first row, or with the first row on which every cleaned column is known
    starts = [Carry(f"__known_{c}", f"min(CASE WHEN {c} IS NOT NULL THEN {series.time} END)", "min") for c in clean]
    starts = starts or [Carry("__known", f"min({series.time})", "min")]
    out = with_carry(df, series, carries, starts)
    first = starts[0].name if len(starts) == 1 else f"greatest({', '.join(c.name for c in starts)})"
    kept = [f"{filled_value(c, series)} AS {c}" if c in clean else c for c in df.columns]
    extra = [f"{filled_value(c, series)} AS __ffill_{c}" for c in fill]
    out = out.selectExpr(
        *kept, *extra, f"{first} AS {START}", f"__before + row_number() {series.local()} - 1 AS {POSITION}"
    )
    names = [*df.columns, *[f"__ffill_{c}" for c in fill]]
    if clean:
        known = " AND ".join(f"{c} IS NOT NULL" for c in clean)
        names = [f"CASE WHEN {known} THEN {c} END AS {c}" if c in clean else c for c in names]
    block = f"{POSITION} div {rows}"
    if margin:
        copies = f"CASE WHEN {POSITION} % {rows} >= {rows - margin} THEN array({block}, {block} + 1) ELSE array({block}) END"
        out = out.selectExpr(*names, START, POSITION, f"explode({copies}) AS {BLOCK}")
    else:
        out = out.selectExpr(*names, START, POSITION, f"{block} AS {BLOCK}")
    cut = [f"{POSITION} div {n} AS {segment_column(n)}" for n in sorted({SEGMENT_ROWS, *segments})]
    return out.selectExpr("*", f"{block} = {BLOCK} AS __own", *cut)


def in_blocks(
    df: DataFrame,
    series: Series,
    build: Callable[[Columns], dict[str, str]],
    rows: int = BLOCK_ROWS,
    fill: Sequence[str] = (),
    clean: Sequence[str] = (),
    drop_incomplete: bool = False,
) -> DataFrame:
    """Evaluate the columns that ``build`` describes over margin blocks; keeps the input columns first."""
    plan = Columns(series, [*df.columns, *[f"__ffill_{c}" for c in fill]])
    outputs = build(plan)
    # a derived input (a return) reaches one row further back than its own frame
    longest = max(plan.segments, default=0)
    margin = max(longest, plan.lookback + len(plan.steps) if plan.lookback else 0)
    margin += -margin % longest if longest else 0
    out = block_frame(df, series, margin, rows, fill, clean, sorted(plan.segments))
    for step in plan.steps:
        out = out.selectExpr("*", *project(step))
    kept = [c for c in df.columns if c not in outputs]
    out = out.where("__own").selectExpr(*kept, *project(outputs))
    if plan.carried and not drop_incomplete:
        out = forward_fill(out, series, [c for c in plan.carried if c in outputs])
    # one test per column: a single test over all of them makes later filters and joins very slow to plan
    return out.where(" AND ".join(f"`{c}` IS NOT NULL" for c in out.columns)) if drop_incomplete else out
