"""Ordered windows over series of any length.

A window partitioned by series key puts a whole series into one task. That is the
right plan while the longest series is moderate: one exchange and one sort serve
every lag, rolling and lead column. When a single key holds a large part of the
table it is not, so :class:`Series` measures the longest series first and, beyond
``rows_per_block``, cuts the long ones into blocks. Each block also receives copies
of the rows just outside it that its frames can reach (``before`` / ``after``
rows), so results are the same as with the uncut window, and the copies are dropped
again afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kilospan.functions.clock import epoch_micros, epoch_seconds, sql_name
from kilospan.plans.sizes import checkpointed, left_lookup

ROWS_PER_BLOCK = 2_000_000
SALTS = 64
# Pieces per block of rows that a node is cut into, their greatest number, and the least
# number of leaves in a block: a block takes whole leaves at both ends.
PIECES = 16
LEAVES = 4
MOST_PIECES = 4096

BLOCK, OWN, BUCKET = "__block", "__own", "__bucket"
START, TOTAL, FIRST, CARRY = "__start", "__total", "__first", "__carry"
WIDEST = "__widest"


@dataclass(frozen=True)
class Along:
    """The ordered window of a series, as SQL text and as a specification.

    A column written as text costs the driver one call instead of one per part.
    """

    by: tuple[str, ...]
    ts: str

    def sql(self, function: str, first: int | None = None, last: int = 0) -> str:
        """``function`` over the series, on the rows ``first`` to ``last`` if given."""
        keys = ", ".join(sql_name(k) for k in self.by)
        frame = ""
        if first is not None:
            frame = f" ROWS BETWEEN {_edge(first)} AND {_edge(last)}"
        return f"{function} OVER (PARTITION BY {keys} ORDER BY {sql_name(self.ts)}{frame})"

    @property
    def spec(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(self.ts)


def _edge(rows: int) -> str:
    if rows == 0:
        return "CURRENT ROW"
    return f"{abs(rows)} {'PRECEDING' if rows < 0 else 'FOLLOWING'}"


@dataclass(frozen=True)
class Series:
    """Which columns make a series, and how long the longest one is.

    ``keys`` and ``ts`` must identify a row (dedupe first). ``step_seconds`` states
    that rows lie on a gapless grid of that step. ``largest`` is an upper bound on
    rows per series and ``total`` the row count; they are measured when absent.
    """

    keys: tuple[str, ...]
    ts: str
    step_seconds: int | None = None
    largest: int | None = None
    total: int | None = None
    rows_per_block: int = ROWS_PER_BLOCK

    @classmethod
    def of(cls, key, ts: str, **kw) -> "Series":
        return cls((key,) if isinstance(key, str) else tuple(key), ts, **kw)

    def measured(self, df: DataFrame) -> "Series":
        """Fill in ``largest`` from the data: one pass over the key columns."""
        if self.largest is not None:
            return self
        sizes = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        top, total = sizes.agg(F.max("n"), F.sum("n")).first()
        return replace(self, largest=top or 0, total=total or 0)

    def measured_grid(self, df: DataFrame, step_seconds: int) -> "Series":
        """Bound the length each series will have once its grid is filled."""
        if self.largest is not None:
            return self
        ts = sql_name(self.ts)
        span = epoch_seconds(f"max({ts})") - epoch_seconds(f"min({ts})")
        sizes = df.groupBy(*self.keys).agg(
            F.greatest(F.count(F.lit(1)), F.floor(span / step_seconds) + 1).alias("n")
        )
        top, total = sizes.agg(F.max("n"), F.sum("n")).first()
        return replace(self, largest=top or 0, total=total or 0)

    def on_grid(self, step_seconds: int) -> "Series":
        return replace(self, step_seconds=step_seconds)

    @property
    def cut(self) -> bool:
        if self.largest is None:
            raise ValueError("call measured() first")
        return self.largest > self.rows_per_block

    def gathered(self, df: DataFrame) -> DataFrame:
        """Bring each series together ahead of a dedupe, where they are of even size.

        A later aggregate on (keys, ts) and every window then reuse this exchange:
        one shuffle of the readings instead of two. If one series is more than twice
        a task's fair share, the dedupe should shrink it before it moves.
        """
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if self.cut or self.total is None or self.largest * tasks > 2 * self.total:
            return df
        return df.repartition(*self.keys)

    def along(self, *extra: str) -> Along:
        return Along((*self.keys, *extra), self.ts)

    def window(self, *extra: str) -> WindowSpec:
        return self.along(*extra).spec

    def over(
        self,
        df: DataFrame,
        compute: Callable[[DataFrame, Along], DataFrame],
        *,
        before: int = 0,
        after: int = 0,
        carry: Column | None = None,
    ) -> DataFrame:
        """Apply ``compute(frame, window)`` to every series.

        ``compute`` may look back ``before`` rows and ahead ``after`` rows. With
        ``carry`` the frame also has a ``__carry`` struct(ts, x): the last row before
        this block whose carry value is not NULL (NULL in an uncut series), and
        ``__first``, the first timestamp of the series (NULL likewise).
        """
        series = self.measured(df)
        if not series.cut:
            if carry is not None:
                df = df.withColumns(
                    {CARRY: F.lit(None).cast(_carry_type(df, series.ts, carry)),
                     FIRST: F.lit(None).cast(df.schema[series.ts].dataType)}
                )
            out = compute(df, series.along())
            return out if carry is None else out.drop(CARRY, FIRST)
        if series.step_seconds and carry is None:
            blocks = series._grid_blocks(df, before, after)
        else:
            blocks = series._counted_blocks(df, before, after, carry)
        out = compute(blocks, series.along(BLOCK))
        return out.where(F.col(OWN)).drop(BLOCK, OWN, CARRY, FIRST)

    def positions(self, df: DataFrame, pos: str = "pos", total: str = "n") -> DataFrame:
        """Add the 1-based place of a row in its series and the series length."""
        series = self.measured(df)
        if not series.cut:
            w = series.window()
            whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return df.withColumns(
                {pos: F.row_number().over(w), total: F.count(F.lit(1)).over(whole)}
            ).withColumns({pos: F.col(pos).cast("bigint")})
        rows = series._located(df, 0, 0, None)
        rows = rows.withColumn(BLOCK, F.when(F.col(START).isNotNull(), F.col(BUCKET)))
        w = series.window(BLOCK)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return rows.withColumns(
            {
                pos: F.coalesce(F.col(START), F.lit(0)) + F.row_number().over(w),
                total: F.coalesce(F.col(TOTAL), F.count(F.lit(1)).over(whole)),
            }
        ).drop(BLOCK, BUCKET, START, TOTAL, FIRST, "__lo", "__at", "__hi")

    def with_totals(self, df: DataFrame, totals: dict[str, Column]) -> DataFrame:
        """Add aggregates over the whole series to each of its rows.

        Moderate series get them in the exchange that other windows use too. Rows of longer
        ones are kept, added up in parts, and looked up by key.
        """
        series = self.measured(df)
        keys = list(series.keys)
        if not series.cut:
            whole = Window.partitionBy(*keys)
            return df.withColumns({name: total.over(whole) for name, total in totals.items()})
        df = checkpointed(df)
        sums = df.groupBy(*keys).agg(*[total.alias(name) for name, total in totals.items()])
        return left_lookup(df, sums, keys)

    # -- long series ---------------------------------------------------------

    def _grid_blocks(self, df: DataFrame, before: int, after: int) -> DataFrame:
        """Blocks by arithmetic: on a gapless grid n rows are n steps."""
        size = max(self.rows_per_block, before + after + 1)
        step = self.step_seconds
        at = epoch_seconds(self.ts)
        block = F.floor(at / F.lit(size * step)).cast("bigint")
        offset = at - block * F.lit(size * step)
        lo = block - (offset < after * step).cast("bigint")
        hi = block + (offset >= (size - before) * step).cast("bigint")
        rows = df.withColumns({"__at": block, "__lo": lo, "__hi": hi})
        return (
            rows.withColumn(BLOCK, F.explode(F.sequence("__lo", "__hi")))
            .withColumn(OWN, F.col(BLOCK) == F.col("__at"))
            .drop("__at", "__lo", "__hi")
        )

    def _counted_blocks(self, df, before: int, after: int, carry) -> DataFrame:
        rows = self._located(df, before, after, carry)
        span = F.coalesce(F.sequence("__lo", "__hi"), F.array(F.lit(0).cast("bigint")))
        return (
            rows.withColumn(BLOCK, F.explode(span))
            .withColumn(OWN, F.col(BLOCK) == F.coalesce("__at", F.lit(0)))
            .drop("__lo", "__hi", "__at", BUCKET, START, TOTAL)
        )

    def _located(self, df, before: int, after: int, carry) -> DataFrame:
        """Rows of long series with the place of their bucket in the series and its blocks.

        Buckets are the leaves of a tree over time. The span of a series is cut into pieces
        of a width of its own, about ``PIECES`` to a block, and a piece that still holds
        more than a quarter of a block is cut again. So the tree is deep only where readings are dense,
        and its nodes are bounded by the rows per block, not by the span. Counts per piece
        are summed among the pieces of one node, from where the node itself begins: no task
        orders the buckets of a whole series, and no row is sorted. Rows of short series
        get NULLs.
        """
        keys = list(self.keys)
        size = max(self.rows_per_block, before + after + 1)
        rows = df.withColumn("__t", epoch_micros(self.ts))
        rows = left_lookup(rows, checkpointed(self._roots(rows, size, carry)), keys)
        leaves = []
        while True:
            cut = F.col("__wide").isNotNull()
            # readings without a time come first in their series
            piece = F.coalesce(F.expr("(__t - __from) div __wide"), F.lit(0).cast("bigint"))
            rows = rows.withColumns(
                {"__parent": F.col(BUCKET), "__piece": F.when(cut, piece),
                 BUCKET: F.when(cut, F.concat_ws("/", BUCKET, piece.cast("string"))).otherwise(F.col(BUCKET))}
            )
            pieces = checkpointed(self._pieces(rows.where(cut), size, carry))
            leaves.append(pieces.where("__wide IS NULL").select(*keys, "__n"))
            below = [START, "__n", *([CARRY] if carry is not None else [])]
            found = pieces.withColumnsRenamed({c: f"__new{c}" for c in below})
            rows = left_lookup(rows.drop("__from", "__wide", "__parent", "__piece"), found, [*keys, BUCKET])
            rows = rows.withColumns({c: F.coalesce(f"__new{c}", c) for c in below})
            rows = rows.drop(*[f"__new{c}" for c in below])
            if pieces.where("__wide IS NOT NULL").isEmpty():
                break
        widest = reduce(DataFrame.unionByName, leaves).groupBy(*keys).agg(F.max("__n").alias(WIDEST))
        rows = left_lookup(rows, widest, keys)
        own = F.floor(F.col(START) / size).cast("bigint")
        lo = own
        if after:
            reach = F.greatest(F.col(START) - after - F.col(WIDEST) + 1, F.lit(0))
            lo = F.floor(reach / size).cast("bigint")
        hi = F.floor((F.col(START) + F.col("__n") + before - 1) / size).cast("bigint")
        return rows.withColumns({"__at": own, "__lo": lo, "__hi": hi}).drop(
            "__t", "__from", "__wide", "__n", WIDEST
        )

    def _roots(self, rows: DataFrame, size: int, carry) -> DataFrame:
        """One node for each long series, with the width of its pieces."""
        found = rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(TOTAL), F.min(self.ts).alias(FIRST),
            F.min("__t").alias("__from"), F.max("__t").alias("__until"),
        ).where(F.col(TOTAL) > self.rows_per_block)
        span = F.col("__until") - F.col("__from") + 1
        columns = {
            BUCKET: F.lit("0"), START: F.lit(0).cast("bigint"), "__n": F.col(TOTAL),
            "__wide": _piece_width(span, F.col(TOTAL), size),
        }
        if carry is not None:
            columns[CARRY] = F.lit(None).cast(_carry_type(rows, self.ts, carry))
        return found.withColumns(columns).drop("__until")

    def _pieces(self, rows: DataFrame, size: int, carry) -> DataFrame:
        """Pieces of the nodes that are cut: their first position, and their own width if
        they are to be cut again."""
        keys = list(self.keys)
        aggs = [
            F.count(F.lit(1)).alias("__n"), F.max(START).alias("__begin"),
            F.max("__from").alias("__from"), F.max("__wide").alias("__wide"),
        ]
        if carry is not None:
            pair = F.struct(F.col(self.ts).alias("ts"), carry.alias("x"))
            known = F.when(carry.isNotNull(), F.col(self.ts))
            aggs += [F.max_by(pair, known).alias("__last"), F.first(CARRY).alias(CARRY)]
        counts = rows.groupBy(*keys, "__parent", "__piece", BUCKET).agg(*aggs)
        earlier = (
            Window.partitionBy(*keys, "__parent").orderBy("__piece")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        placed = {START: F.col("__begin") + F.coalesce(F.sum("__n").over(earlier), F.lit(0))}
        if carry is not None:
            placed[CARRY] = F.coalesce(F.last("__last", ignorenulls=True).over(earlier), F.col(CARRY))
        again = (F.col("__n") * LEAVES > size) & (F.col("__wide") > 1)
        return counts.withColumns(placed).select(
            *keys, BUCKET, START, "__n", *([CARRY] if carry is not None else []),
            (F.col("__from") + F.col("__piece") * F.col("__wide")).alias("__from"),
            F.when(again, _piece_width(F.col("__wide"), F.col("__n"), size)).alias("__wide"),
        )


def _piece_width(span: Column, rows: Column, size: int) -> Column:
    """Width of the pieces a node is cut into: at most ``MOST_PIECES``, each of 1 at least."""
    pieces = F.least(F.ceil(rows * PIECES / size), F.lit(MOST_PIECES))
    return F.ceil(span / pieces).cast("bigint")


def first_rows(df: DataFrame, keys: list[str], order: Column, n: int) -> DataFrame:
    """The first ``n`` rows of each key by ``order``, with their ``__place`` from 1.

    Spark limits such a rank ahead of the shuffle up to a configured ``n``. Beyond
    that, the rows of a key are first limited in salted parts.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salted = Window.partitionBy(*keys, "__salt").orderBy(order)
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        df = df.withColumn("__place", F.row_number().over(salted))
        df = df.where(F.col("__place") <= n).drop("__salt", "__place")
    placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return placed.where(F.col("__place") <= n)


def _carry_type(df: DataFrame, ts: str, carry: Column) -> str:
    pair = df.select(F.struct(F.col(ts).alias("ts"), carry.alias("x")).alias("c"))
    return pair.schema["c"].dataType.simpleString()
