"""Exact interpolated quantiles that stay distributed.

``percentile`` keeps a count per distinct value of a group in one place. That is exact and
fast for a bounded number of rows, and impossible for billions of continuous readings.
Beyond the bound :func:`exact_quantiles` selects instead of sorting, in two passes over the
values whatever the number of columns, groups and probabilities:

1. a mergeable sketch per group and column brackets the ranks that are asked for;
2. rows inside a bracket are counted per value, rows beyond its nearer end as one number.

The counts tell the exact rank of every value in a bracket, and so prove it: a bracket that
does not hold its ranks is widened and counted again. Inside, brackets are cut into cells,
so that only the values of the one or two cells that hold the ranks are ever put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.plans.sizes import checkpointed, left_lookup, match

MAX_DISTINCT = 500_000
ACCURACY = 10_000
CELLS = 1024
# Half widths of the brackets, as shares of a group, and the rows from which on a sketch of
# this accuracy is sure to bracket the rank. Smaller groups are taken whole.
WIDTHS = ((2 / ACCURACY, 2 * ACCURACY), (0.02, 200))


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: list[float],
    by: list[str] = (),
    *,
    max_distinct: int = MAX_DISTINCT,
    superset: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """One row per group with an array of quantiles (linear rule) per named column.

    ``at_most`` is a known bound on the rows of ``df``. ``superset`` names a table with at
    least as many rows that is cheap to count, or ``df`` itself where that is a plain scan.
    An input that is more than a scan is computed once and kept for the passes over it.
    """
    by = list(by)
    values = df.select(
        *by, *[F.nanvl(c.cast("double"), F.lit(None)).alias(n) for n, c in columns.items()]
    )
    if at_most is None and superset is not None:
        at_most = superset.count()
    if at_most is None or (at_most > max_distinct and superset is not df):
        values = checkpointed(values)
        at_most = values.count()
    if at_most <= max_distinct:
        ps = F.array(*[F.lit(float(p)) for p in probs])
        return values.groupBy(*by).agg(*[F.percentile(n, ps).alias(n) for n in columns])
    return _selected(values, list(columns), [float(p) for p in probs], by)


def _selected(values: DataFrame, columns: list[str], probs: list[float], by: list[str]) -> DataFrame:
    sketch = checkpointed(_sketch(values, columns, probs, by))
    for width in range(len(WIDTHS) + 1):
        marks = checkpointed(_marks(values, _brackets(sketch, columns, probs, by, width), columns, by))
        found = checkpointed(_ranked(marks, by))
        if not found.where("__v0 IS NULL OR __v1 IS NULL").limit(1).count():
            break
    # weighted as percentile does it, so that results do not depend on the way taken
    at_rank = F.col("__p") * (F.col("__n") - 1)
    between = (F.col("__r1") - at_rank) * F.col("__v0") + (at_rank - F.col("__r0")) * F.col("__v1")
    value = F.when(F.col("__v0") == F.col("__v1"), F.col("__v0")).otherwise(between)
    at = lambda c, i: F.max(F.when((F.col("__c") == c) & (F.col("__i") == i), value))
    wide = found.groupBy(*by).agg(
        *[
            F.when(F.count_if(F.col("__c") == c) > 0, F.array(*[at(c, i) for i in range(len(probs))])).alias(n)
            for c, n in enumerate(columns)
        ]
    )
    # groups without any value have a row too
    return left_lookup(sketch.select(*by), wide, by).select(*by, *columns) if by else wide


def _sketch(values: DataFrame, columns, probs, by) -> DataFrame:
    """Per group and column: count, ends, and the bracket ends of every width."""
    ends = [min(max(p + s * w, 0.0), 1.0) for p in probs for w, _ in WIDTHS for s in (-1, 1)]
    grid = F.array(*[F.lit(e) for e in ends])
    return values.groupBy(*by).agg(
        *[
            F.struct(
                F.count(n).alias("n"), F.min(n).alias("lo"), F.max(n).alias("hi"),
                F.percentile_approx(n, grid, ACCURACY).alias("grid"),
            ).alias(n)
            for n in columns
        ]
    )


def _brackets(sketch: DataFrame, columns, probs, by, width: int) -> DataFrame:
    """``__brackets`` per group: for each column c and probability i the ranks r0 and r1 and
    the values lo and hi around them. Attempts from ``width`` on use wider ones."""
    found = []
    for c, name in enumerate(columns):
        of = lambda field, name=name: F.col(name)[field]
        for i, p in enumerate(probs):
            lo, hi = of("lo"), of("hi")
            for w in reversed(range(width, len(WIDTHS))):
                share, least = WIDTHS[w]
                at = 2 * (i * len(WIDTHS) + w)
                enough = of("n") >= least
                if p - share > 0:
                    lo = F.when(enough, of("grid")[at]).otherwise(lo)
                if p + share < 1:
                    hi = F.when(enough, of("grid")[at + 1]).otherwise(hi)
            rank = F.lit(p) * (of("n") - 1)
            found.append(
                F.struct(
                    F.lit(c).alias("c"), F.lit(i).alias("i"), F.lit(p).alias("p"), of("n").alias("n"),
                    lo.alias("lo"), hi.alias("hi"),
                    F.floor(rank).alias("r0"), F.ceil(rank).alias("r1"),
                )
            )
    return sketch.select(*by, F.filter(F.array(*found), lambda b: b["n"] > 0).alias("__brackets"))


def _marks(values: DataFrame, brackets: DataFrame, columns, by) -> DataFrame:
    """Rows per bracket and value. Rows beyond the nearer end of the range (above for upper
    quantiles) have no value; rows beyond the other end need no mark."""
    if by:
        # only groups that have values, so that a row finds its brackets or has nothing to mark
        table = brackets.withColumnsRenamed({c: f"__on_{c}" for c in by})
        rows = values.join(table, match(values, table, by)).drop(*[f"__on_{c}" for c in by])
    else:
        # an aggregate without keys has one row, whose brackets become a literal
        row = brackets.first()["__brackets"]
        literal = F.array(
            *[F.struct(*[F.lit(x).alias(n) for n, x in b.asDict().items()]) for b in row]
        ).cast(brackets.schema["__brackets"].dataType)
        rows = values.withColumn("__brackets", literal)
    cells = F.array(*columns)
    own = lambda b: F.get(cells, b["c"])
    upper = lambda b: b["p"] >= 0.5
    near = F.filter("__brackets", lambda b: F.when(upper(b), own(b) >= b["lo"]).otherwise(own(b) <= b["hi"]))
    marks = F.transform(
        near,
        lambda b: F.struct(
            *[b[f].alias(f"__{f}") for f in ("c", "i", "p", "n", "lo", "hi", "r0", "r1")],
            F.when(own(b).between(b["lo"], b["hi"]), own(b)).alias("__x"),
        ),
    )
    of = [f"__{f}" for f in ("c", "i", "p", "n", "lo", "hi", "r0", "r1")]
    return rows.select(*by, F.inline(marks)).groupBy(*by, *of, "__x").agg(F.count(F.lit(1)).alias("__m"))


def _ranked(marks: DataFrame, by: list[str]) -> DataFrame:
    """The values at ranks r0 and r1 of every bracket, NULL where it does not hold them."""
    of = [f"__{f}" for f in ("c", "i", "p", "n", "r0", "r1")]
    keys = [*by, "__c", "__i"]
    upper = F.col("__p") >= 0.5
    # halves, so that the width of the widest range is a number; one without a width is a cell
    lo, x, hi = (F.col(c) / 2 for c in ("__lo", "__x", "__hi"))
    share = F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0))
    inside = F.least(F.floor(F.nanvl(share, F.lit(1.0)) * CELLS), F.lit(CELLS)).cast("int")
    beyond = F.when(upper, F.lit(CELLS + 1)).otherwise(F.lit(-1))
    placed = marks.withColumn("__cell", F.when(F.col("__x").isNull(), beyond).otherwise(inside))
    cells = placed.groupBy(*by, *of, "__cell").agg(F.sum("__m").alias("__m"))
    whole = Window.partitionBy(*keys)
    first = F.when(upper, F.col("__n") - F.sum("__m").over(whole)).otherwise(F.lit(0))
    cells = cells.withColumn("__until", first + F.sum("__m").over(whole.orderBy("__cell")))
    cells = cells.withColumn("__from", F.col("__until") - F.col("__m"))
    real = F.col("__cell").between(0, CELLS)
    holds = lambda r, a, b: (F.col(a) <= F.col(r)) & (F.col(r) < F.col(b))
    held = holds("__r0", "__from", "__until") | holds("__r1", "__from", "__until")
    chosen = cells.where(real & held).select(*keys, "__cell", "__from")
    on = chosen.withColumnsRenamed({c: f"__on_{c}" for c in [*keys, "__cell"]})
    values = placed.join(on, match(placed, on, [*keys, "__cell"])).drop(
        *[f"__on_{c}" for c in [*keys, "__cell"]]
    )
    along = Window.partitionBy(*keys, "__cell").orderBy("__x")
    values = values.withColumn("__end", F.col("__from") + F.sum("__m").over(along))
    values = values.withColumn("__begin", F.col("__end") - F.col("__m"))
    pick = lambda r: F.max(F.when(holds(r, "__begin", "__end"), F.col("__x")))
    ends = values.groupBy(*keys).agg(pick("__r0").alias("__v0"), pick("__r1").alias("__v1"))
    # every bracket has marks, so one that holds nothing it should shows as NULL
    return left_lookup(cells.select(*by, *of).distinct(), ends, keys)
