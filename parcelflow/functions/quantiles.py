"""Exact, linearly interpolated quantiles that stay distributed.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a continuous field (price per square foot) or a hot
group (one county holding a third of the rows) lands in one task. Two ways here:

Whole columns (no ``by``): selection by bounded histograms. A bracket is a range
of values known to hold wanted ranks, at first ``[min, max]``. Each level counts
every bracket's values in at most ``accuracy`` equal bins, with each bin's least
and largest value, by map-side aggregation; only the histograms, bounded by
``bracket_limit`` rows, reach the driver. A wanted rank's next bracket is the
``[min, max]`` of its bin, and is done where both are equal, so ties never stall
it. A field of at most ``small_n`` distinct values is counted by value at once.
No values are shuffled, a level reads the narrow columns once, and a billion
rows take three or four levels. A few named groups (``exact_percentiles_of``) are
columns of this kind, one for each group and field.

Groups (``by``): ranks by range partitioning. Values are sorted by (group, value)
over range partitions in one shuffle, with a salt as the last sort key, so equal
values and hot groups spread over partitions. Each partition leaves its runs of
equal values with their count and the group's rows before them; prefix sums of
the partitions' counts per group place every partition in its group's order, and
a wanted rank is then one run of one partition. No task holds a group, whatever
the number of groups or their sizes.

The interpolation is ``lo + (hi - lo) * frac`` with ``pos = (n - 1) * p``, the same
linear method as pandas ``quantile`` and DuckDB ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.session import cut_lineage

#: Groups times fields up to which groups are selected by histograms.
FEW = 64
#: Distinct values up to which a whole column is counted by value.
DISTINCT = 10_000


def _columns(fields: Sequence[str] | Mapping[str, Column | str]) -> dict[str, Column]:
    items = fields.items() if isinstance(fields, Mapping) else [(f, f) for f in fields]
    return {k: F.nanvl(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), F.lit(None).cast("double")) for k, c in items}


def _long(df: DataFrame, keep: Sequence[str], names: Sequence, columns: Sequence[Column], name: str = "field") -> DataFrame:
    """(*keep, field, v) with a row for each value that is not null."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name), c.alias("v")) for n, c in zip(names, columns, strict=True)])
    return df.select(*keep, F.inline(pairs)).where(F.col("v").isNotNull())


def exact_percentiles(
    df: DataFrame,
    fields: Sequence[str] | Mapping[str, Column | str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    small_n: int | None = None,
    broadcast_rows: int = 200_000,
    bracket_limit: int = 200_000,
    staged: bool = False,
) -> DataFrame:
    """Exact quantiles per group, field and probability.

    Returns columns ``*by, field, p, n, value``. Null and NaN values are
    ignored (pandas ``dropna`` semantics); rows with a null group key are
    dropped, as pandas ``groupby`` drops them. Without ``by`` the columns are
    read several times, from a narrow stage table unless ``staged`` says that
    ``df`` is cheap to read again."""
    by, probs = list(by), sorted({float(p) for p in probs})
    columns = _columns(fields)
    if by:
        known = df.where(" AND ".join(f"`{b}` IS NOT NULL" for b in by))
        return _by_ranges(_long(known, by, list(columns), list(columns.values())), by, probs, broadcast_rows)
    narrow = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns.values())])
    if not staged:
        narrow = cut_lineage(narrow)
    long = _long(narrow, [], range(len(columns)), [F.col(c) for c in narrow.columns], "k")
    found = _by_histograms(long, probs, max(2, accuracy), DISTINCT if small_n is None else small_n, bracket_limit)
    names = list(columns)
    return df.sparkSession.createDataFrame([(names[k], p, n, v) for k, p, n, v in found], "field string, p double, n long, value double")


def exact_percentiles_of(
    df: DataFrame,
    groups: DataFrame,
    fields: Sequence[str] | Mapping[str, Column | str],
    probs: Sequence[float],
    accuracy: int = 10_000,
    bracket_limit: int = 200_000,
) -> DataFrame:
    """``exact_percentiles`` of the few ``groups`` named by a table of their distinct keys,
    which are columns of ``df`` and not null: selection by histograms, a column for each group
    and field, so no value is shuffled. ``df`` is read several times."""
    columns, spark, by = _columns(fields), df.sparkSession, groups.columns
    known = groups.collect()
    numbered = spark.createDataFrame([(*r, i) for i, r in enumerate(known)], T.StructType([*groups.schema.fields, T.StructField("_group", T.IntegerType())]))
    narrow = df.select(*by, *[c.alias(f"_c{i}") for i, c in enumerate(columns.values())]).join(F.broadcast(numbered), by)
    long = _long(narrow, ["_group"], range(len(columns)), [F.col(f"_c{i}") for i in range(len(columns))], "field")
    long = long.select((F.col("_group") * len(columns) + F.col("field")).alias("k"), "v")
    found = _by_histograms(long, sorted({float(p) for p in probs}), max(2, accuracy), DISTINCT, bracket_limit)
    names = list(columns)
    rows = [(*known[k // len(names)], names[k % len(names)], p, n, v) for k, p, n, v in found]
    extra = [T.StructField("field", T.StringType()), T.StructField("p", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("value", T.DoubleType())]
    return spark.createDataFrame(rows, T.StructType([*groups.schema.fields, *extra]))


# ------------------------------------------------------------ whole columns


def _ranks(n: int, probs: Sequence[float]) -> set[int]:
    return {f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}


def _pick(x: Column, low: Sequence[float], found: Sequence[Column]) -> Column:
    """``found`` of the last entry whose ``low`` is at most ``x`` (the first, if none), by halving."""
    if len(low) == 1:
        return found[0]
    m = len(low) // 2
    return F.when(x < F.lit(low[m]), _pick(x, low[:m], found[:m])).otherwise(_pick(x, low[m:], found[m:]))


def _bracket(k: Column, v: Column, brackets: Sequence[tuple]) -> Column:
    """Index of the bracket (k, low, high, ...) that holds a value, else null. Those
    of a column are disjoint, so a value is compared with the logarithm of their number."""
    of: dict[int, list[tuple[float, Column]]] = {}
    for i, (key, low, high, *_) in enumerate(brackets):
        of.setdefault(key, []).append((low, F.when((k == F.lit(key)) & v.between(low, high), F.lit(i))))
    keys = sorted(of)
    trees = [_pick(v, *zip(*sorted(of[key], key=lambda b: b[0]), strict=True)) for key in keys]
    return _pick(k, keys, trees)


def _bin(v: Column, i: Column, brackets: Sequence[tuple], exact: Sequence[bool], bins: int) -> Column:
    """Bin of a value of bracket ``i``, whose ends differ; order is kept. The value
    itself is the bin where ``exact``."""
    of = lambda values: F.get(F.array(*[F.lit(x) for x in values]), i)
    ends = [(float(low), float(high)) for _, low, high, *_ in brackets]
    scales = [1.0 if math.isfinite(high - low) else 0.5 for low, high in ends]
    starts = [low * s for (low, _), s in zip(ends, scales, strict=True)]
    widths = [high * s - start for (_, high), s, start in zip(ends, scales, starts, strict=True)]
    inner = F.floor((v * of(scales) - of(starts)) / of(widths) * bins).cast("double")
    if not all(map(math.isfinite, widths)):
        inner = F.when(of([math.isfinite(w) for w in widths]), inner).otherwise(F.lit(bins // 2).cast("double"))
    at = F.when(v == of([high for _, high in ends]), F.lit(bins - 1.0)).when(v == of([low for low, _ in ends]), F.lit(0.0)).otherwise(F.least(inner, F.lit(bins - 1.0)))
    return F.when(of(exact), v).otherwise(at) if any(exact) else at


def _by_histograms(long: DataFrame, probs: Sequence[float], bins: int, distinct: int, rows: int) -> list[tuple[int, float, int, float]]:
    """(k, p, n, value) of the columns ``k`` of ``long`` (k, v)."""
    v = F.col("v")
    stats = {r.k: r for r in long.groupBy("k").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.approx_count_distinct("v").alias("d")).collect()}
    found: dict[tuple[int, int], float] = {}
    #: (k, low, high, values below, wanted ranks)
    brackets = [(k, s.low, s.high, 0, sorted(_ranks(s.n, probs))) for k, s in stats.items()]
    level = 0
    while True:
        for f, low, high, _, ranks in brackets:
            if low == high:
                found.update(((f, k), low) for k in ranks)
        brackets = [b for b in brackets if b[1] != b[2]]
        if not brackets:
            break
        size = max(2, min(bins, rows // len(brackets)))
        exact = [level == 0 and stats[b[0]].d <= distinct for b in brackets]
        inside = long.select("v", _bracket(F.col("k"), v, brackets).alias("i")).where("i IS NOT NULL")
        bars: dict[int, list] = {}
        for b in (inside.select("v", "i", _bin(v, F.col("i"), brackets, exact, size).alias("at")).groupBy("i", "at")
                  .agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("low"), F.max("v").alias("high")).collect()):
            bars.setdefault(b.i, []).append(b)
        nxt = []
        for i, (f, _, _, below, ranks) in enumerate(brackets):
            own = sorted(bars[i], key=lambda b: b["at"])
            upto = below + np.cumsum([b.m for b in own])
            wanted: dict[int, list[int]] = {}
            for k in ranks:
                wanted.setdefault(int(np.searchsorted(upto, k, "right")), []).append(k)
            nxt += [(f, own[j].low, own[j].high, int(upto[j] - own[j].m), ks) for j, ks in wanted.items()]
        brackets, level = nxt, level + 1
    out = []
    for f, s in sorted(stats.items()):
        for p in probs:
            pos = float(s.n - 1) * p
            low, high = found[f, math.floor(pos)], found[f, math.ceil(pos)]
            out.append((f, p, s.n, low if low == high else low + (high - low) * (pos - math.floor(pos))))
    return out


# ------------------------------------------------------------------- groups


def _runs(keys: Sequence[str]):
    """Runs of equal values of a sorted partition, with the rows of the same
    group before each. A run may be cut in two by a batch's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group = np.zeros(n, bool)
            group[0] = True
            for k in keys:
                c = batch.column(k)
                group[1:] |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, n - 1)))
            value = np.asarray(batch.column("v"))
            head = group.copy()
            head[1:] |= value[1:] != value[:-1]
            at, groups = np.flatnonzero(head), np.flatnonzero(group)
            first = groups[np.searchsorted(groups, at, "right") - 1]
            before = at - first
            if last == tuple(batch.column(k)[0] for k in keys):
                before = before + np.where(first == 0, seen, 0)
            else:
                seen = 0
            last = tuple(batch.column(k)[n - 1] for k in keys)
            seen = n - groups[-1] + (seen if len(groups) == 1 else 0)
            cut = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(np.diff(np.append(at, n))), pa.array(before)], names=[*cut.schema.names, "c", "start"])
    return run


def _by_ranges(long: DataFrame, by: list[str], probs: Sequence[float], broadcast_rows: int) -> DataFrame:
    keys = [*by, "field"]
    salt = F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(1 << 16))
    ranged = long.withColumn("_salt", salt).repartitionByRange(*keys, "v", "_salt").sortWithinPartitions(*keys, "v")
    ranged = ranged.select(F.spark_partition_id().alias("_part"), *keys, "v")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    runs = cut_lineage(ranged.mapInArrow(_runs(keys), f"{schema}, c long, start long"))
    # one row for each group and partition that it reaches
    parts = runs.groupBy(*keys, "_part").agg(F.sum("c").alias("m"))
    order = Window.partitionBy(*keys).orderBy("_part")
    parts = parts.withColumns({"before": F.coalesce(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                               "n": F.sum("m").over(Window.partitionBy(*keys))})
    wanted = parts.select("*", F.explode(F.array(*[F.lit(p) for p in probs])).alias("p")).withColumn("pos", (F.col("n") - 1).cast("double") * F.col("p"))
    wanted = wanted.select("*", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), f("pos").alias("k")) for s, f in (("lo", F.floor), ("hi", F.ceil))])))
    wanted = wanted.where("k >= before AND k < before + m").select(*keys, "_part", "n", "p", "pos", "side", (F.col("k") - F.col("before")).alias("k"))
    wanted = cut_lineage(wanted)
    if wanted.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    hit = runs.join(wanted, [*keys, "_part"]).where("k >= start AND k < start + c")
    ends = hit.groupBy(*keys, "p", "n", "pos").agg(*[F.max(F.when(F.col("side") == s, F.col("v"))).alias(s) for s in ("lo", "hi")])
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos")))
    return ends.select(*keys, "p", "n", value.alias("value"))


def exact_percentiles_wide(
    df: DataFrame,
    specs: Sequence[tuple[str, str | Column, float]],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    staged: bool = False,
    groups: DataFrame | None = None,
) -> DataFrame:
    """One row per group with one column per ``(out_name, value, p)`` spec, of
    the few ``groups`` only if they are given.

    Groups where every spec value is null are absent; left-join onto the
    group's counts when they must appear."""
    by = list(by)
    fields: dict[str, Column | str] = {}
    spec_keys = []
    for i, (out, col, p) in enumerate(specs):
        key = col if isinstance(col, str) else f"_q{i}"
        fields.setdefault(key, col)
        spec_keys.append((out, key, float(p)))
    probs = sorted({p for _, _, p in spec_keys})
    if groups is not None:
        by, long = groups.columns, exact_percentiles_of(df, groups, fields, probs, accuracy)
    else:
        long = exact_percentiles(df, fields, probs, by=by, accuracy=accuracy, staged=staged)
    aggs = [
        F.max(F.when((F.col("field") == f) & (F.col("p") == F.lit(p)), F.col("value"))).alias(out)
        for out, f, p in spec_keys
    ]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)
