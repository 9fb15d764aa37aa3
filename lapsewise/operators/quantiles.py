"""Exact interpolated percentiles per group, for groups of any size, by one plan.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, which a group that
holds a third of the table does not fit. Here no task sees a group:

1. Rows are dealt once, by group and shard. The shard is the input partition's number modulo ``SHARDS``,
   so a hot group, and a hot value of it, is spread over so many parts.
2. Each part is sorted and keeps at most ``POINTS`` of its values, evenly spaced by rank, with the
   number of rows that each stands for.
3. A group's kept values, in order, bound every wanted rank from both sides: rows up to a kept value
   are at least those that the values up to it stand for, and at most so many more as one space of
   each part. Where all parts kept all their values (as a rule, groups of up to ten thousand
   rows) both bounds are the value sought, and the group is done.
4. For the others the bounds go back to the parts, which count what is below them and send what is
   between them: at most two rows in ``POINTS`` for each wanted rank. The value sought is among these.

So rows are shuffled once, and what follows is bounded by ``SHARDS * POINTS`` for each group and by a
small share of its rows. The source is read once; steps 2 and 4 read the same shuffle. Means and numbers of
rows come along. A caller who knows that no group is large may ask for one buffer per group
(``buffered``); nothing is measured to choose between the two.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.skew import as_names

#: Parts that a group is dealt over, and values that each part keeps.
SHARDS = 512
POINTS = 8192


def _dealt(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows (``__g``, ``__shard``, ``__v``), one for each row and column, dealt by the first two.

    ``__g`` is one struct of the key (``k0``, ``k1``, ...) and the column's number ``c``; it is never null,
    so plain equality joins it.
    """
    keys = [F.col(k).alias(f"k{i}") for i, k in enumerate(by)]
    if len(columns) == 1:
        rows = df.select(F.struct(*keys, F.lit(0).alias("c")).alias("__g"), F.col(columns[0]).cast("double").alias("__v"))
    else:
        each = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
        rows = df.select(*keys, F.explode(each).alias("__e"))
        rows = rows.selectExpr(f"struct({', '.join([f'k{i}' for i in range(len(by))] + ['__e.c AS c'])}) AS __g", "__e.v AS __v")
    # A small group's rows stay together where they lie together; all rows as one group are dealt by
    # value too. The shard is said to be never null, or a join would put a null test below
    # the shuffle, which then could not be used again.
    salt = "spark_partition_id()" if by else "xxhash64(__v, spark_partition_id())"
    shard = f"coalesce(cast(pmod({salt}, {SHARDS}) AS int), 0) AS __shard"
    return rows.selectExpr("*", shard).repartition("__g", "__shard")


def _kept(dealt: DataFrame) -> DataFrame:
    """The evenly spaced values of each part with the number of rows that they stand for (``__w``).

    ``__last`` of a part's last one: its number of rows, sum, smallest value and widest space less one. It
    is an array, as all its uses then read one column and so share one shuffle.
    """
    # A number first: what is sorted by a struct first compares field by field.
    part = "OVER (PARTITION BY __p, __g, __shard"
    rows = dealt.selectExpr("*", "xxhash64(__g, __shard) AS __p").selectExpr(
        "__g",
        "__v",
        f"cast(row_number() {part} ORDER BY __v NULLS LAST) AS bigint) AS __r",
        f"count(__v) {part}) AS __m",
        f"array(cast(count(1) {part}) AS double), sum(__v) {part}), min(__v) {part})) AS __whole",
    )
    # Kept ranks are the m * j / POINTS, rounded up; all of them if there are no more. A part without
    # values keeps one row that stands for none.
    spaces = f"((__r - 1) * {POINTS} DIV greatest(__m, 1))"
    rows = rows.where(f"__r <= __m AND __r * {POINTS} DIV greatest(__m, 1) > {spaces} OR __m = 0 AND __r = 1")
    widest = f"cast(greatest((__m + {POINTS - 1}) DIV {POINTS} - 1, 0) AS double)"
    return rows.selectExpr(
        "__g",
        "__v",
        f"CASE WHEN __m = 0 THEN 0L ELSE __r - ({spaces} * __m + {POINTS - 1}) DIV {POINTS} END AS __w",
        f"CASE WHEN __r = __m OR __m = 0 THEN concat(__whole, array({widest})) END AS __last",
    )


def _bounded(kept: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per group: the keys, ``c`` and ``__b``, an array of the number of rows and of values, the sum, and for each
    wanted rank (two for each p) the rank and the values that it lies between (null: none known).

    It is an array for the same reason as above, and dealt once more, by the keys alone, so that both its
    uses share that shuffle instead of the work before it.
    """
    group = ", ".join([*keys, "c"])
    rows = kept.selectExpr(*[f"__g.{k}" for k in keys], "__g.c", "__v", "__w", "__last")
    rows = rows.selectExpr(
        *keys,
        "c",
        "__v",
        "__w",
        "__last",
        f"sum(__w) OVER (PARTITION BY {group} ORDER BY __v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __until",
        f"sum(__w) OVER (PARTITION BY {group}) AS __n",
        f"cast(sum(__last[3]) OVER (PARTITION BY {group}) AS bigint) AS __loose",
    )
    parts = ["sum(__last[0])", "cast(max(__n) AS double)", "sum(__last[1])"]
    for p in probs:
        for rounded in ("floor", "ceil"):
            rank = f"cast({rounded}({p}D * (__n - 1)) AS bigint)"
            parts.append(f"cast({rounded}({p}D * (max(__n) - 1)) AS double)")
            if p in (0.0, 1.0):
                parts += ["min(__last[2])" if p == 0.0 else "max(__v)"] * 2
            else:
                parts.append(f"max(CASE WHEN __until - __w + __loose <= {rank} THEN __v END)")
                parts.append(f"min(CASE WHEN __until > {rank} THEN __v END)")
    grouped = rows.groupBy(*keys, "c").agg(F.expr(f"array({', '.join(parts)})").alias("__b"))
    return grouped.repartition(*(keys or ["c"]))


def _settled(dealt: DataFrame, bounded: DataFrame, keys: Sequence[str], n_ranks: int) -> DataFrame:
    """Rows (keys, ``c``, ``__b``, ``s0``, ``s1``, ...): a group's row of ``bounded`` with the values that are known, and further
    rows, without ``__b``, with those that had to be looked for. Partitioned by the keys alone."""
    lo, hi = ([f"__b[{3 + 3 * j + at}]" for j in range(n_ranks)] for at in (1, 2))
    wanted = ", ".join(
        f"CASE WHEN NOT ({lo[j]} <=> {hi[j]}) THEN struct({j} AS slot, cast(__b[{3 + 3 * j}] AS bigint) AS rank, {lo[j]} AS lo, {hi[j]} AS hi) END"
        for j in range(n_ranks)
    )
    bounds = bounded.selectExpr(f"struct({', '.join([*keys, 'c'])}) AS __g", f"filter(array({wanted}), x -> x IS NOT NULL) AS __slots")
    # A test that cannot be moved below the shuffle that both uses of ``bounded`` share.
    bounds = bounds.where("CASE WHEN spark_partition_id() >= 0 THEN size(__slots) > 0 END").selectExpr("*", f"explode(sequence(0, {SHARDS - 1})) AS __shard")
    near = dealt.join(bounds, ["__g", "__shard"]).selectExpr("__g", "__shard", "__v", "explode(__slots) AS __s")
    # Put so that no null test is drawn from it. What lies below the bounds is only counted, under no value.
    near = near.where("coalesce(__v <= __s.hi, false)").selectExpr(
        "__g", "__shard", "__s.slot AS __slot", "__s.rank AS __rank", "CASE WHEN coalesce(__v >= __s.lo, true) THEN __v END AS __v"
    )
    near = near.groupBy("__g", "__shard", "__slot", "__rank", "__v").agg(F.count(F.lit(1)).alias("__w"))
    near = near.selectExpr(*[f"__g.{k}" for k in keys], "__g.c", "__slot", "__rank", "__v", "__w").repartition(*(keys or ["c"]))
    running = f"PARTITION BY {', '.join([*keys, 'c', '__slot'])} ORDER BY __v NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    near = near.selectExpr(*keys, "c", "__slot", "__rank", "__v", "__w", f"sum(__w) OVER ({running}) AS __until")
    near = near.where("__until > __rank AND __until - __w <= __rank")
    found = near.selectExpr(*keys, "c", "cast(NULL AS array<double>) AS __b", *[f"CASE WHEN __slot = {j} THEN __v END AS s{j}" for j in range(n_ranks)])
    known = bounded.selectExpr(*keys, "c", "__b", *[f"CASE WHEN {lo[j]} <=> {hi[j]} THEN {lo[j]} END AS s{j}" for j in range(n_ranks)])
    return known.unionAll(found)


def summarise(
    df: DataFrame,
    key: str | Sequence[str],
    percentiles: Mapping[str, Mapping[str, float]],
    means: Mapping[str, str] | None = None,
    count_as: str | None = None,
    values_as: str | None = None,
    buffered: bool = False,
) -> DataFrame:
    """One row per group of ``key`` (of all rows, if that is empty): percentiles of numeric columns.

    ``percentiles`` maps an input column to ``{output name: p}``, ``means`` an input column to an
    output name; nulls are skipped, and a group without values gives null. ``count_as`` names the
    number of rows, ``values_as`` the number of values of the first column. No rows, no groups.
    """
    by, means, columns = as_names(key), dict(means or {}), list(percentiles)
    wanted = sorted({float(p) for probs in percentiles.values() for p in probs.values()})
    outputs: dict[str, Column] = {}
    if buffered:
        aggs = [F.count(F.lit(1)).alias("__all"), F.count(columns[0]).alias("__n")]
        for i, name in enumerate(columns):
            points = [float(p) for p in percentiles[name].values()]
            aggs.append(F.percentile(F.col(name).cast("double"), points).alias(f"__q{i}"))
            outputs.update({a: F.col(f"__q{i}")[j] for j, a in enumerate(percentiles[name])})
        aggs += [F.mean(name).alias(f"__m{i}") for i, name in enumerate(means)]
        outputs.update({a: F.col(f"__m{i}") for i, a in enumerate(means.values())})
        picked = df.groupBy(*by).agg(*aggs).where("__all > 0")
    else:
        keys = [f"k{i}" for i in range(len(by))]
        dealt = _dealt(df, by, columns)
        found = _settled(dealt, _bounded(_kept(dealt), keys, wanted), keys, 2 * len(wanted))

        def of(i: int, value: str) -> str:
            return f"max(CASE WHEN c = {i} THEN {value} END)"

        aggs = ["cast(max(__b[0]) AS bigint) AS __all", f"cast({of(0, '__b[1]')} AS bigint) AS __n"]
        for i, name in enumerate(columns):
            aggs.append(f"{of(i, '__b[2]')} / nullif({of(i, '__b[1]')}, 0D) AS __mean{i}")
            for a, p in percentiles[name].items():
                j = 2 * wanted.index(float(p))
                place, lo, hi = f"({float(p)}D * ({of(i, '__b[1]')} - 1))", of(i, f"s{j}"), of(i, f"s{j + 1}")
                value = f"CASE WHEN {lo} <=> {hi} THEN {lo} ELSE (ceil({place}) - {place}) * {lo} + ({place} - floor({place})) * {hi} END"
                outputs[a] = F.col(f"__p{len(outputs)}")
                aggs.append(f"{value} AS __p{len(outputs) - 1}")
        outputs.update({a: F.col(f"__mean{columns.index(name)}") for name, a in means.items()})
        picked = found.groupBy(*keys).agg(*[F.expr(x) for x in aggs])
        if not by:
            picked = picked.where("__all IS NOT NULL")
        picked = picked.withColumnsRenamed(dict(zip(keys, by)))
    extra = [(count_as, "__all"), (values_as, "__n")]
    return picked.select(
        *by, *[F.col(c).alias(a) for a, c in extra if a], *[c.alias(a) for a, c in outputs.items()]
    )


def sketched(
    df: DataFrame,
    key: str | Sequence[str],
    percentiles: Mapping[str, Mapping[str, float]],
    means: Mapping[str, str] | None = None,
    count_as: str | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """As :func:`summarise`, with Spark's bounded sketch instead of exact percentiles, in one pass."""
    by, aggs, outputs = as_names(key), [], {}
    for i, (name, probs) in enumerate(percentiles.items()):
        points = [float(p) for p in probs.values()]
        aggs.append(F.percentile_approx(F.col(name).cast("double"), points, accuracy).alias(f"__q{i}"))
        outputs.update({a: F.col(f"__q{i}")[j] for j, a in enumerate(probs)})
    count = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    means = dict(means or {})
    grouped = df.groupBy(*by).agg(*count, *[F.mean(c).alias(a) for c, a in means.items()], *aggs)
    return grouped.select(*by, *([count_as] if count_as else []), *means.values(), *[c.alias(a) for a, c in outputs.items()])


def overall_percentiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    count_as: str | None = None,
    buffered: bool = False,
) -> DataFrame:
    """One row of exact percentiles of a whole column; nulls are skipped.

    An empty or all-null column gives no row.
    """
    rows = df.select(F.col(value).cast("double").alias("__value")).where(F.col("__value").isNotNull())
    return summarise(rows, [], {"__value": probs}, values_as=count_as, buffered=buffered)
