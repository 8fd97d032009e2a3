"""Ordered computations over key groups of any size.

``ordered`` adds columns such as lag, running counts or null filling. A plain
window would give a whole key group to one task, so groups are cut into blocks
along their order:

1. rows are range-partitioned by keys, order and a hash of the row; the partition
   is the block. Its size depends on the number of partitions only, whatever the
   keys, the types and the values of the sort columns: a long run of equal sort
   values is cut by the hash;
2. the window runs inside ``(key, block)``, and the rows are written once;
3. each block is reduced to one summary row per key (count, last value, ...);
4. a window over the summaries carries the state on. Only keys that lie in several
   blocks need any, which are at most two a block, its first and its last;
5. that state is broadcast (at most two rows a block) and added to the rows, which
   stay where they are.

Where a run of equal sort values lies in several blocks, summaries of the first
and the last run of a block tell its rows about their peers elsewhere, so that
ranks and RANGE frames are those of the whole run.

``chained`` computes several outputs that depend on each other over one such
partitioning: the rows are written by block, and each step's windows run on them
where they lie; only its summaries are shuffled.

There is one form for any size: nothing is counted to choose between plans. The
result is that of the plain window, which ``split=False`` gives for groups that are
known to be small, such as the rows of one order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.session import cut_in_place, cut_lineage, small_side

_FIRST, _CURRENT, _LAST = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing
_BEFORE = (Window.unboundedPreceding, -1)


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``"ts"`` sorts ascending with NULLs first, ``"-ts"`` descending with NULLs last."""
    return [F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_first() for o in order]


def spec(keys: Sequence[str], order: Sequence[str] = ()):
    """Window specification from column names."""
    w = Window.partitionBy(*keys)
    return w.orderBy(*sort_columns(order)) if order else w


def _frame(w, frame: str):
    return w.rowsBetween(_FIRST, _CURRENT) if frame == "rows" else w.rangeBetween(_FIRST, _CURRENT)


def join_null_safe(l: DataFrame, r: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equally named keys where NULL matches NULL; the keys come from the left."""
    side = r.withColumnsRenamed({k: f"__j_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in keys]
    out = l.join(side, cond, how)
    return out.drop(*[f"__j_{k}" for k in keys])


class Output:
    """One computed column. ``plain`` is the single-window form; the other
    methods give the per-block value, the block summary, the carried state and
    their combination. A row whose key lies in one block has no carried state.

    Outputs that see their peers (rows of equal sort values) also have ``run``,
    the summary of the rows of one run that ``inside`` selects, and ``peers``, which
    combines those of the run's blocks in a frame; ``{n}_before`` and ``{n}_after``
    are that of the row's run in earlier and in later blocks."""

    ties = False

    def plain(self, w) -> Column:
        raise NotImplementedError

    def local(self, w, n: str) -> dict[str, Column]:
        return {f"{n}_l": self.plain(w)}

    def summary(self, n: str) -> dict[str, Column]:
        raise NotImplementedError

    def carry(self, w, n: str) -> dict[str, Column]:
        raise NotImplementedError

    def run(self, n: str, inside: Column) -> Column:
        raise NotImplementedError

    def peers(self, n: str, w) -> Column:
        raise NotImplementedError

    def result(self, n: str) -> Column:
        raise NotImplementedError


class _Additive(Output):
    """Local running number plus the sum of that number over earlier blocks."""

    def carry(self, w, n):
        return {f"{n}_c": F.coalesce(F.sum(f"{n}_s").over(w.rowsBetween(*_BEFORE)), F.lit(0))}

    def peers(self, n, w):
        return F.sum(f"{n}_r").over(w)

    def result(self, n):
        return F.col(f"{n}_l") + F.coalesce(f"{n}_c", F.lit(0))


class RowNumber(_Additive):
    def plain(self, w):
        return F.row_number().over(w)

    def summary(self, n):
        return {f"{n}_s": F.count(F.lit(1)).cast("int")}

    def result(self, n):
        return super().result(n).cast("int")


class Rank(RowNumber):
    ties = True

    def plain(self, w):
        return F.rank().over(w)

    def run(self, n, inside):
        return F.count_if(inside)

    def result(self, n):
        return (_Additive.result(self, n) - F.coalesce(f"{n}_before", F.lit(0))).cast("int")


class DenseRank(RowNumber):
    ties = True

    def plain(self, w):
        return F.dense_rank().over(w)

    def summary(self, n):
        return {f"{n}_s": F.max(f"{n}_l")}

    def run(self, n, inside):
        return F.lit(0)

    def result(self, n):
        # a run that goes on in the next block was counted in both
        return (_Additive.result(self, n) - F.coalesce("__joins", F.lit(0))).cast("int")


@dataclass
class RunningCount(_Additive):
    """Number of rows so far for which ``cond`` is true (NULL counts as not true)."""

    cond: Column
    frame: str = "rows"

    def _one(self):
        return F.when(self.cond, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))

    def plain(self, w):
        return F.sum(self._one()).over(_frame(w, self.frame))

    @property
    def ties(self):
        return self.frame == "range"

    def summary(self, n):
        return {f"{n}_s": F.sum(self._one())}

    def run(self, n, inside):
        return F.sum(F.when(inside, self._one()))

    def result(self, n):
        whole = super().result(n)
        return whole + F.coalesce(f"{n}_after", F.lit(0)) if self.ties else whole


@dataclass
class RunningMin(Output):
    value: Column
    frame: str = "range"

    def plain(self, w):
        return F.min(self.value).over(_frame(w, self.frame))

    def summary(self, n):
        return {f"{n}_s": F.min(self.value)}

    @property
    def ties(self):
        return self.frame == "range"

    def carry(self, w, n):
        return {f"{n}_c": F.min(f"{n}_s").over(w.rowsBetween(*_BEFORE))}

    def run(self, n, inside):
        return F.min(F.when(inside, self.value))

    def peers(self, n, w):
        return F.min(f"{n}_r").over(w)

    def result(self, n):
        return F.least(f"{n}_l", f"{n}_c", *([f"{n}_after"] if self.ties else []))


@dataclass
class LastValue(Output):
    """Last non-NULL value up to the current row."""

    value: Column
    frame: str = "range"

    def plain(self, w):
        return F.last(self.value, ignorenulls=True).over(_frame(w, self.frame))

    def summary(self, n):
        return {f"{n}_s": F.max_by(f"{n}_l", "__rn")}

    @property
    def ties(self):
        return self.frame == "range"

    def carry(self, w, n):
        return {f"{n}_c": F.last(f"{n}_s", ignorenulls=True).over(w.rowsBetween(*_BEFORE))}

    def run(self, n, inside):
        return F.max_by(self.value, F.when(inside & self.value.isNotNull(), F.col("__rn")))

    def peers(self, n, w):
        return F.last(f"{n}_r", ignorenulls=True).over(w)

    def result(self, n):
        return F.coalesce(*([f"{n}_after"] if self.ties else []), f"{n}_l", f"{n}_c")


@dataclass
class FirstValue(Output):
    """First non-NULL value up to the current row."""

    value: Column
    frame: str = "range"

    def plain(self, w):
        return F.first(self.value, ignorenulls=True).over(_frame(w, self.frame))

    def summary(self, n):
        return {f"{n}_s": F.max_by(f"{n}_l", "__rn")}

    @property
    def ties(self):
        return self.frame == "range"

    def carry(self, w, n):
        return {f"{n}_c": F.first(f"{n}_s", ignorenulls=True).over(w.rowsBetween(*_BEFORE))}

    def run(self, n, inside):
        return F.min_by(self.value, F.when(inside & self.value.isNotNull(), F.col("__rn")))

    def peers(self, n, w):
        return F.first(f"{n}_r", ignorenulls=True).over(w)

    def result(self, n):
        return F.coalesce(f"{n}_c", f"{n}_l", *([f"{n}_after"] if self.ties else []))


@dataclass
class NextValue(Output):
    """First non-NULL value from the current row (and its peers) on: ``LastValue`` of the reversed order."""

    value: Column
    ties = True

    def plain(self, w):
        return F.first(self.value, ignorenulls=True).over(w.rangeBetween(_CURRENT, _LAST))

    def summary(self, n):
        return {f"{n}_s": F.min_by(self.value, F.when(self.value.isNotNull(), F.col("__rn")))}

    def carry(self, w, n):
        return {f"{n}_c": F.first(f"{n}_s", ignorenulls=True).over(w.rowsBetween(1, _LAST))}

    def run(self, n, inside):
        return F.min_by(self.value, F.when(inside & self.value.isNotNull(), F.col("__rn")))

    def peers(self, n, w):
        return F.first(f"{n}_r", ignorenulls=True).over(w)

    def result(self, n):
        return F.coalesce(f"{n}_before", f"{n}_l", f"{n}_c")


@dataclass
class Lag(Output):
    value: Column

    def plain(self, w):
        return F.lag(self.value, 1).over(w)

    def local(self, w, n):
        return {f"{n}_l": self.plain(w), f"{n}_v": self.value}

    def summary(self, n):
        return {f"{n}_s": F.max_by(F.struct(F.col(f"{n}_v").alias("v")), F.col("__rn"))}

    def carry(self, w, n):
        return {f"{n}_c": F.lag(f"{n}_s", 1).over(w)}

    def result(self, n):
        return F.when(F.col("__rn") > 1, F.col(f"{n}_l")).otherwise(F.col(f"{n}_c")["v"])


@dataclass
class Lead(Output):
    """Value ``n`` rows further on. A block hands on its first ``n`` rows only."""

    value: Column
    n: int = 1

    def plain(self, w):
        return F.lead(self.value, self.n).over(w)

    def local(self, w, n):
        return {f"{n}_l": self.plain(w), f"{n}_v": self.value}

    def summary(self, n):
        head = F.when(F.col("__rn") <= self.n, F.struct(F.col("__rn").alias("r"), F.col(f"{n}_v").alias("v")))
        return {f"{n}_s": F.array_sort(F.collect_list(head)), f"{n}_k": F.count(F.lit(1))}

    def carry(self, w, n):
        return {
            f"{n}_c": F.flatten(F.collect_list(f"{n}_s").over(w.rowsBetween(1, self.n))),
            f"{n}_k": F.col(f"{n}_k"),
        }

    def result(self, n):
        beyond = F.lit(self.n) - (F.col(f"{n}_k") - F.col("__rn"))
        return F.when(F.col(f"{n}_k").isNull() | (beyond <= 0), F.col(f"{n}_l")).otherwise(F.get(F.col(f"{n}_c"), (beyond - 1).cast("int"))["v"])


@dataclass
class Total(Output):
    """Aggregate of the whole key group, repeated on each row (sum, min, max, count)."""

    fn: str
    value: Column

    _merge = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
    _first = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}

    def plain(self, w):
        return self._first[self.fn](self.value).over(w.rowsBetween(_FIRST, _LAST))

    def whole(self):
        return self._first[self.fn](self.value)

    def summary(self, n):
        return {f"{n}_s": self._first[self.fn](self.value)}

    def carry(self, w, n):
        return {f"{n}_c": self._merge[self.fn](f"{n}_s").over(w.rowsBetween(_FIRST, _LAST))}

    def result(self, n):
        return F.coalesce(f"{n}_c", f"{n}_l")


_DEFAULTS = {"string": "", "boolean": False, "date": "1970-01-01"}


def _filler(dtype: T.DataType) -> Column:
    name = dtype.simpleString()
    if name.startswith("timestamp"):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    return F.lit(_DEFAULTS.get(name, 0)).cast(dtype)


Step = Mapping[str, Output] | tuple[Sequence[str], Mapping[str, Output]] | Callable[[DataFrame], DataFrame]


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Output], *, split: bool = True) -> DataFrame:
    """Add ``outputs`` computed per key group in ``order``; without an order, of the whole group."""
    keys, order = list(keys), list(order)
    if split and not order:
        # whole groups: partial aggregates and an inner join, which adaptive execution splits where a key is hot
        work, group = _named_keys(df, keys)
        sums = work.groupBy(*group).agg(*[out.whole().alias(f"__o{i}") for i, out in enumerate(outputs.values())])
        keep = [c for c in df.columns if c not in outputs]
        return work.join(sums, group, "inner").select(*keep, *[F.col(f"__o{i}").alias(name) for i, name in enumerate(outputs)])
    return chained(df, keys, order, [outputs], split=split)


def chained(df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Sequence[Step], *, split: bool = True) -> DataFrame:
    """Several ``ordered`` computations over one partitioning by ``keys`` and ``order``.

    A step is a mapping of outputs; or ``(further keys, outputs)``, for groups
    within those of ``keys``; or a function that adds columns or drops rows but
    changes no key or order column. Each step sees the columns of those before it.
    """
    keys, order = list(keys), list(order)
    if not split:
        for step in steps:
            if callable(step):
                df = step(df)
            else:
                further, outputs = step if isinstance(step, tuple) else ((), step)
                w = spec([*keys, *further], order)
                df = df.withColumns({name: out.plain(w) for name, out in outputs.items()})
        return df

    blocks_n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work, group = _named_keys(df, keys)
    # equal sort values are cut by a hash of the row; equal rows, by the partition they come from
    plain_types = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    cut = F.xxhash64(*plain_types, F.spark_partition_id())
    work = work.repartitionByRange(blocks_n, *group, *sort_columns(order), cut).withColumn("__b", F.spark_partition_id())
    helpers, written = [*group, "__b"], False
    windows = sum(not callable(step) for step in steps)
    several = windows > 1
    if several:
        # the block is known only while the rows lie in their range, so it is written with them
        work = cut_lineage(work)
    for step in steps:
        if callable(step):
            work = step(work)
            continue
        further, outputs = step if isinstance(step, tuple) else ((), step)
        inner, parts = _named_keys(work, list(further), "__w") if further else (work, [])
        at, keep = [*group, *parts, "__b"], [c for c in work.columns if c not in outputs]
        w_in = Window.partitionBy(*at).orderBy(*sort_columns(order))
        ties = any(out.ties for out in outputs.values())
        local = {"__rn": F.row_number().over(w_in), **({"__rk": F.rank().over(w_in)} if ties else {})}
        names = {name: f"__o{i}" for i, name in enumerate(outputs)}
        for name, out in outputs.items():
            local.update(out.local(w_in, names[name]))
        detail = inner.withColumns(local)
        if ties:
            detail = detail.withColumn("__lr", F.max("__rk").over(Window.partitionBy(*at)))
        # each step's summaries and the steps after it read the rows, so of more than two steps each is written
        if not written or windows > 2:
            detail, written = (cut_in_place if several else cut_lineage)(detail), True
        state = _state(detail, [*group, *parts], outputs, names, order, ties)
        # keys in several blocks are the first or last of a block: two rows a block; within them further keys are not bounded
        side = small_side(cut_lineage(state)) if further else F.broadcast(state)
        joined = detail.join(side, at, "left")
        if ties:
            first, last = F.col("__rk") == 1, F.col("__rk") == F.col("__lr")
            joined = joined.withColumns({f"{n}_{where}": F.when(edge, F.col(f"{n}_{where}")) for n in names.values() for where, edge in (("before", first), ("after", last))})
        work = joined.select(*keep, *[out.result(names[name]).alias(name) for name, out in outputs.items()])
    return work.drop(*helpers)


def _named_keys(df: DataFrame, keys: Sequence[str], prefix: str = "__k") -> tuple[DataFrame, list[str]]:
    """Keys are made non-NULL once, so that window, aggregate and join all hash the same columns."""
    norm = {f"{prefix}{i}": F.coalesce(F.col(k), _filler(df.schema[k].dataType)) for i, k in enumerate(keys)}
    nulls = F.concat_ws("", *[F.col(k).isNull().cast("int").cast("string") for k in keys])
    return df.withColumns({**norm, f"{prefix}nulls": nulls}), [*norm, f"{prefix}nulls"]


def _state(detail: DataFrame, group: list[str], outputs: Mapping[str, Output], names: Mapping[str, str], order: Sequence[str], ties: bool) -> DataFrame:
    """The carried state of each block of a key that lies in several blocks."""
    sums: dict[str, Column] = {}
    for name, out in outputs.items():
        sums.update(out.summary(names[name]))
    peers = {names[name]: out for name, out in outputs.items() if out.ties}
    if ties:
        first, last = F.col("__rk") == 1, F.col("__rk") == F.col("__lr")
        value = F.struct(*[F.col(o.lstrip("-")).alias(f"v{i}") for i, o in enumerate(order)])
        sums |= {"__first": F.min_by(value, "__rn"), "__last": F.max_by(value, "__rn")}
        for n, out in peers.items():
            sums |= {f"{n}_rf": out.run(n, first), f"{n}_rl": out.run(n, last)}
    blocks = detail.groupBy(*group, "__b").agg(*[c.alias(n) for n, c in sums.items()])
    whole = Window.partitionBy(*group)
    blocks = blocks.withColumn("__blocks", F.count(F.lit(1)).over(whole)).where("__blocks > 1")
    w_sum = whole.orderBy("__b")
    carried: dict[str, Column] = {}
    for name, out in outputs.items():
        carried.update(out.carry(w_sum, names[name]))
    if not ties:
        return blocks.select(*group, "__b", *[c.alias(n) for n, c in carried.items()])
    goes_on = F.coalesce((F.lag("__last").over(w_sum) == F.col("__first")).cast("int"), F.lit(0))
    state = blocks.select(*group, "__b", "__first", "__last", *[c.alias(n) for n, c in carried.items()], goes_on.alias("__on"), *[F.col(f"{n}_r{e}") for n in peers for e in "fl"])
    state = state.withColumn("__joins", F.sum("__on").over(w_sum.rowsBetween(_FIRST, _CURRENT)))
    one = F.col("__first") == F.col("__last")  # the block lies in one run

    def run(value: str, sums: str, is_first: bool, is_last: bool) -> Column:
        held = [F.col(f"{n}_{sums}").alias(f"{n}_r") for n in peers]
        return F.struct(F.col(value).alias("v"), F.lit(is_first).alias("f"), F.lit(is_last).alias("l"), *held)

    runs = F.when(one, F.array(run("__first", "rf", True, True))).otherwise(F.array(run("__first", "rf", True, False), run("__last", "rl", False, True)))
    opened = state.select(*group, "__b", F.inline(runs))
    w_run = Window.partitionBy(*group, "v").orderBy("__b")
    around = {f"{n}_{where}": out.peers(n, w_run.rowsBetween(*frame)) for n, out in peers.items() for where, frame in (("before", _BEFORE), ("after", (1, _LAST)))}
    opened = opened.withColumns(around)
    edges = [F.first(F.when(F.col("f" if c.endswith("before") else "l"), F.struct(F.col(c).alias("x"))), ignorenulls=True)["x"].alias(c) for c in around]
    missing = [F.lit(None).cast("int").alias(f"{n}_{where}") for n in names.values() if n not in peers for where in ("before", "after")]
    told = opened.groupBy(*group, "__b").agg(*edges).select("*", *missing)
    return state.select(*group, "__b", *carried, "__joins").join(F.broadcast(told), [*group, "__b"])
