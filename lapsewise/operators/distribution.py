"""The numbers behind six kinds of distribution figure, computed in Spark.

Each operator returns a small frame to draw from: a row per category, bin, box or grid point,
times one per value of ``hue`` if that is given. No raw column leaves the executors. Rows
without a usable value (null, NaN, infinite) or without a group are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

from lapsewise.operators import skew
from lapsewise.operators.quantiles import overall_percentiles, summarise

_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

# Cells of a density for each bandwidth, moments kept of each, and how many bandwidths a kernel reaches.
_CELLS = 32
_MOMENTS = 12
_REACH = 39.0


def _values(
    df: DataFrame, value: str, groups: Sequence[str]
) -> tuple[DataFrame, list[str], dict[str, str]]:
    """The finite values as double column ``__v`` with the group columns, which go by neutral
    names meanwhile; also those names, and how to turn them back."""
    back = {f"__g{i}": name for i, name in enumerate(groups)}
    rows = df.select(
        *[F.col(name).alias(g) for g, name in back.items()], _number(df, value).alias("__v")
    )
    rows = rows.where(F.abs(F.col("__v")) < F.lit(math.inf))  # NaN is not, null neither
    return (rows.dropna(subset=list(back)) if back else rows), list(back), back


def _number(df: DataFrame, value: str) -> Column:
    """A column as double; times and dates as seconds since 1970 (UTC)."""
    kind = df.schema[value].dataType
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double") * 86400
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(F.col(value).cast("timestamp"), F.current_timezone())) / 1e6
    if isinstance(kind, TimestampType):
        return F.unix_micros(value) / 1e6
    return F.col(value).cast("double")


def _with_stats(rows: DataFrame, stats: DataFrame, by: Sequence[str]):
    """Every row with its group's statistics; without groups, with the one row there is."""
    if by:
        return skew.attach_group_values(rows, stats, by)
    names = stats.columns
    one = stats.select(F.struct(*names).alias("s")).scalar()
    return rows.withColumn("__stats", one).select(
        *rows.columns, *[F.col("__stats")[n].alias(n) for n in names]
    )


def _groups(*names: str | None) -> list[str]:
    return list(dict.fromkeys(n for n in names if n))


def count_distribution(df: DataFrame, x: str, hue: str | None = None) -> DataFrame:
    """Rows per category."""
    by = _groups(x, hue)
    return df.dropna(subset=by).groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def line_distribution(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """Mean of ``y`` at each ``x``, in order of ``x``."""
    by = _groups(hue, x)
    usable = df.dropna(subset=[*by, y])
    if isinstance(df.schema[y].dataType, (DoubleType, FloatType)):
        usable = usable.where(~F.isnan(y))
    return usable.groupBy(*by).agg(F.mean(y).alias(y)).orderBy(*by)


def _auto_bins(n: Column, lo: Column, hi: Column, iqr: Column) -> Column:
    """Number of bins: the narrower of the Freedman-Diaconis and Sturges widths."""
    spread = hi - lo
    sturges = spread / (F.log2(n) + 1)
    freedman = F.lit(2.0) * iqr / F.pow(n, F.lit(1.0 / 3.0))
    width = F.when(freedman > 0, F.least(freedman, sturges)).otherwise(sturges)
    return F.when(spread > 0, F.ceil(spread / width)).otherwise(F.lit(1)).cast("long")


def histogram(
    df: DataFrame,
    x: str,
    hue: str | None = None,
    bins: str | int | Sequence[float] = "auto",
    buffered: bool = False,
) -> DataFrame:
    """Counts per bin as ``bin``, ``bin_start``, ``bin_end``, ``count``, empty bins included.

    Bins are closed on the left, the last one on both sides, and common to all values of
    ``hue``. ``bins`` is ``"auto"``, a number of equal bins, or the edges themselves (values
    outside them are not counted). With no spread there is one bin of width one around the
    value. A time or date is binned by its seconds since 1970. The values of a text or boolean
    column are themselves the bins: the rows are then ``hue``, the value and ``count``.
    ``buffered`` finds the quartiles behind ``"auto"`` in one buffer (see ``quantiles``).
    """
    if isinstance(df.schema[x].dataType, (StringType, BooleanType)):
        return _category_counts(df, x, hue)
    rows, by, back = _values(df, x, _groups(hue))
    v = F.col("__v")
    if not isinstance(bins, (str, int)):
        edges = [float(e) for e in bins]
        if len(edges) < 2 or any(b <= a for a, b in zip(edges, edges[1:])):
            raise ValueError("bin edges must be at least two and increasing")
        points = F.array(*[F.lit(e) for e in edges])
        last = len(edges) - 2
        index = F.when(v == edges[-1], F.lit(last)).otherwise(
            F.size(F.filter(points, lambda e: e <= v)) - 1
        )
        kept = rows.where((v >= edges[0]) & (v <= edges[-1]))
        placed = kept.withColumn("bin", index.cast("long"))
        start, end = [F.get(points, (F.col("bin") + i).cast("int")) for i in (0, 1)]
        counted = placed.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"))
        all_bins = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("bin")
        some = rows.select(*by).distinct() if by else rows.agg(F.count("__v").alias("n")).where("n > 0")
        grid = some.select(*by, all_bins)
        return _filled(grid, counted, by).select(
            *by, "bin", start.alias("bin_start"), end.alias("bin_end"), "count"
        ).withColumnsRenamed(back)
    if isinstance(bins, str) and bins != "auto":
        raise ValueError(f"unknown bins {bins!r}: expected 'auto', a number or edges")
    if isinstance(bins, int) and bins < 1:
        raise ValueError("the number of bins must be positive")

    if bins == "auto":
        points = {"lo": 0.0, "q1": 0.25, "q3": 0.75, "hi": 1.0}
        stats = overall_percentiles(rows, "__v", points, "n", buffered).select(
            "lo",
            "hi",
            _auto_bins(F.col("n"), F.col("lo"), F.col("hi"), F.col("q3") - F.col("q1")).alias("k"),
        )
    else:
        stats = rows.agg(F.min("__v").alias("lo"), F.max("__v").alias("hi")).withColumn(
            "k", F.lit(bins).cast("long")
        )
    flat = F.col("lo") == F.col("hi")
    stats = stats.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "k",
    )
    lo, hi, k = F.col("lo"), F.col("hi"), F.col("k")
    width = (hi - lo) / k
    guess = F.least(F.floor((v - lo) / (hi - lo) * k), k - 1)
    # The quotient may round across an edge; compare with the edges themselves.
    settled = (
        F.when(v < lo + F.col("bin") * width, F.col("bin") - 1)
        .when((F.col("bin") < k - 1) & (v >= lo + (F.col("bin") + 1) * width), F.col("bin") + 1)
        .otherwise(F.col("bin"))
    )
    counted = (
        _with_stats(rows, stats, [])
        .withColumn("bin", guess)
        .withColumn("bin", settled)
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    some = _with_stats(rows.select(*by).distinct(), stats, []) if by else stats.where("lo IS NOT NULL")
    all_bins = F.explode(F.sequence(F.lit(0).cast("long"), k - 1)).alias("bin")
    grid = some.select(*by, "lo", "hi", "k", all_bins)
    end = F.when(F.col("bin") == k - 1, hi).otherwise(lo + (F.col("bin") + 1) * width)
    return _filled(grid, counted, by).select(
        *by, "bin", (lo + F.col("bin") * width).alias("bin_start"), end.alias("bin_end"), "count"
    ).withColumnsRenamed(back)


def _filled(grid: DataFrame, counted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every bin of the grid with its count, 0 where nothing was counted."""
    whole = grid.join(counted, [*by, "bin"], "left")
    return whole.withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def _category_counts(df: DataFrame, x: str, hue: str | None) -> DataFrame:
    """Rows per value, for every value of ``hue`` those that it lacks too."""
    by = _groups(hue)
    rows = df.select(*by, x).dropna()
    counted = rows.groupBy(*by, x).agg(F.count(F.lit(1)).alias("count"))
    if not by or hue == x:
        return counted
    # As many rows as the figure has bars: distinct values are paired, not rows.
    values = counted.agg(F.sort_array(F.collect_set(x)).alias("values"))
    grid = counted.select(*by).distinct().withColumn("values", values.scalar())
    whole = grid.select(*by, F.explode("values").alias(x)).join(counted, [*by, x], "left")
    return whole.withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def _quartiles(rows: DataFrame, by: Sequence[str], buffered: bool) -> DataFrame:
    return summarise(rows, by, {"__v": _QUARTILES}, count_as="n", buffered=buffered)


def box(
    df: DataFrame,
    x: str,
    y: str | None = None,
    hue: str | None = None,
    buffered: bool = False,
) -> DataFrame:
    """Quartiles, whiskers and outliers of ``y`` per ``x``, or of ``x`` itself without ``y``.

    Whiskers end at the most extreme values within 1.5 interquartile ranges of the box; the
    values beyond are counted, not listed.
    """
    rows, by, back = _values(df, y or x, _groups(x, hue) if y else _groups(hue))
    quartiles = _quartiles(rows, by, buffered)
    v, reach = F.col("__v"), (F.col("q3") - F.col("q1")) * F.lit(1.5)
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = (v >= low) & (v <= high)
    return (
        _with_stats(rows, quartiles, by)
        .groupBy(*by)
        .agg(
            F.max("n").alias("n"),
            *[F.max(q).alias(q) for q in _QUARTILES],
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"),
        )
        .withColumnsRenamed(back)
    )


def _hermite(order: int) -> list[list[int]]:
    """Coefficients, by power, of the probabilists' Hermite polynomials below ``order``."""
    rows = [[1], [0, 1]]
    for k in range(1, order - 1):
        up, down = [0, *rows[k]], [*rows[k - 1], 0, 0]
        rows.append([x - k * y for x, y in zip(up, down)])
    return rows[:order]


def _density(
    rows: DataFrame,
    by: Sequence[str],
    gridsize: int,
    cut: float,
    common_norm: bool,
) -> DataFrame:
    """Gaussian density on an even grid per group: ``by``, ``grid``, ``x``, ``density``.

    A fast Gauss transform. Values are put into cells of a 32nd of a bandwidth, and a cell keeps the sums of its
    values' powers, below ``_MOMENTS``, around its middle; these combine on the map side. Only cells
    meet the grid: with t and u the distances of a grid point and of a value from the
    middle, in bandwidths, the kernel exp(-(t - u)^2 / 2) is exp(-t^2 / 2) times the sum of He_k(t) u^k / k!.
    As |u| <= 1/64 and |He_k(t)| <= (|t| + sqrt(k))^k, what is cut off is below the sum of ((39 + sqrt(k)) / 64)^k / k!
    over k >= 12 at any t, 2e-11 of the first term: the far tails keep ten digits too, up to ``_REACH`` bandwidths,
    where the kernel underflows to zero. So a row costs a dozen products, whatever the grid, and
    no value is shuffled. Groups of one value or without spread have no density.
    """
    spread = rows.groupBy(*by).agg(
        F.count("__v").alias("n"),
        F.stddev_samp("__v").alias("sd"),
        F.min("__v").alias("lo"),
        F.max("__v").alias("hi"),
    )
    total = rows.agg(F.count("__v")).scalar() if common_norm and by else F.col("n")
    bw = F.pow(F.col("n"), F.lit(-0.2)) * F.col("sd")
    stats = (
        spread.where(F.col("sd") > 0)
        .withColumn("bw", bw)
        .select(
            *by,
            "lo",
            "bw",
            (F.col("lo") - F.lit(cut) * F.col("bw")).alias("first"),
            (
                (F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("bw")) / F.lit(gridsize - 1)
            ).alias("step"),
            (F.lit(1.0) / (total * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))).alias("weight"),
        )
    )
    place = (F.col("__v") - F.col("lo")) / F.col("bw")
    near = _with_stats(rows, stats.select(*by, "lo", "bw"), by).where(F.col("bw").isNotNull())
    near = near.select(*by, place.alias("__p")).withColumn("cell", F.floor(F.col("__p") * _CELLS))
    near = near.select(*by, "cell", (F.col("__p") - (F.col("cell") + 0.5) / _CELLS).alias("u1"))
    for half in (1, 2, 4):
        near = near.withColumn(f"u{2 * half}", F.col(f"u{half}") * F.col(f"u{half}"))
    powers = [F.lit(1.0)]
    for k in range(1, _MOMENTS):
        powers.append(math.prod((F.col(f"u{bit}") for bit in (1, 2, 4, 8) if k & bit), start=F.lit(1.0 / math.factorial(k))))
    moments = near.groupBy(*by, "cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])

    cells = _with_stats(moments, stats, by)
    middle = F.col("lo") + (F.col("cell") + 0.5) / _CELLS * F.col("bw")
    reach = F.lit(_REACH) * F.col("bw")

    def grid_index(at: Column, rounded) -> Column:
        index = (at - F.col("first")) / F.col("step")
        return rounded(F.least(F.greatest(index, F.lit(-1.0)), F.lit(float(gridsize)))).cast("int")

    nearest = F.greatest(F.lit(0), grid_index(middle - reach, F.floor))
    furthest = F.least(F.lit(gridsize - 1), grid_index(middle + reach, F.ceil))
    at_grid = (F.col("first") + F.col("grid") * F.col("step")).alias("x")
    # The series as a polynomial in t: of each power, the moments times their polynomials' coefficients.
    table = _hermite(_MOMENTS)
    terms = [
        reduce(lambda a, b: a + b, [F.col(f"m{k}") * float(row[j]) for k, row in enumerate(table) if j < len(row) and row[j]])
        for j in range(_MOMENTS)
    ]
    series = F.col(f"c{_MOMENTS - 1}")
    for j in range(_MOMENTS - 2, -1, -1):
        series = series * F.col("t") + F.col(f"c{j}")
    mass = (
        cells.select(
            *by, "cell", "step", "bw", "weight",
            *[c.alias(f"c{j}") for j, c in enumerate(terms)],
            F.explode(F.sequence(nearest, furthest)).alias("grid"),
        )
        # From the grid's start, as the middle is: no digits are lost where values are far from zero.
        .withColumn("t", F.col("grid") * F.col("step") / F.col("bw") - F.lit(cut) - (F.col("cell") + 0.5) / _CELLS)
        .groupBy(*by, "grid")
        .agg(F.sum(F.exp(F.col("t") * F.col("t") * F.lit(-0.5)) * series * F.col("weight")).alias("mass"))
    )
    grid = stats.select(
        *by, "first", "step", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid")
    ).select(*by, "grid", at_grid)
    density = F.greatest(F.coalesce(F.col("mass"), F.lit(0.0)), F.lit(0.0)).alias("density")
    return grid.join(mass, [*by, "grid"], "left").select(*by, "grid", "x", density)


def kde(
    df: DataFrame,
    x: str,
    hue: str | None = None,
    gridsize: int = 200,
    cut: float = 3.0,
    common_norm: bool = True,
) -> DataFrame:
    """Gaussian kernel density of ``x`` with Scott's bandwidth.

    With ``hue`` there is one curve per value on a grid of its own; under ``common_norm`` the
    areas of all curves together are one, otherwise each is one.
    """
    rows, by, back = _values(df, x, _groups(hue))
    return _density(rows, by, gridsize, cut, common_norm).withColumnsRenamed(back)


def violin(
    df: DataFrame,
    x: str,
    y: str | None = None,
    hue: str | None = None,
    gridsize: int = 100,
    cut: float = 2.0,
    buffered: bool = False,
) -> DataFrame:
    """Density of ``y`` per ``x`` (or of ``x`` itself) with the group's quartiles in each row."""
    rows, by, back = _values(df, y or x, _groups(x, hue) if y else _groups(hue))
    curve = _density(rows, by, gridsize, cut, common_norm=False)
    quartiles = _quartiles(rows, by, buffered)
    return _with_stats(curve, quartiles, by).withColumnsRenamed(back)


KINDS = ("count", "line", "box", "hist", "kde", "violin")


def distribution(
    df: DataFrame,
    kind: str,
    x: str,
    y: str | None = None,
    hue: str | None = None,
    **options,
) -> DataFrame:
    """Any of the six kinds by name. A pandas frame is handed to the active session first."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}: expected one of {list(KINDS)}")
    if not isinstance(df, DataFrame):
        import pandas as pd

        if not isinstance(df, pd.DataFrame):
            raise TypeError(f"expected a Spark or pandas DataFrame, got {type(df).__name__}")
        df = SparkSession.active().createDataFrame(df)
    if kind == "line":
        if y is None:
            raise ValueError("a line needs y")
        return line_distribution(df, x, y, hue, **options)
    if kind == "box":
        return box(df, x, y, hue, **options)
    if kind == "violin":
        return violin(df, x, y, hue, **options)
    one_sided = {"count": count_distribution, "hist": histogram, "kde": kde}
    return one_sided[kind](df, x, hue, **options)
