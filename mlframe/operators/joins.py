"""Join operators.

The as-of lookup (J7) is the core piece: Spark's public API has no as-of
join, so it is expressed as a union of spine and feature rows followed by a
``last(struct, ignorenulls)`` window. Several lookups sharing a key are
answered by one window, hence one shuffle. Hot keys are split by a time
bucket; a small per-(key, bucket) carry table feeds the last value across
bucket borders, so the answer stays exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mlframe.operators.ranking import _left


@dataclass
class AsOfLookup:
    """Point-in-time lookup: latest ``feats`` row with ``ts <= spine ts``."""

    feats: DataFrame
    on: list[str]
    ts: str
    cols: list[str] | None = None
    max_age: str | None = None  # e.g. "7 days": older matches become null
    rename: dict = field(default_factory=dict)

    def feature_cols(self):
        skip = set(self.on) | {self.ts}
        return self.cols or [c for c in self.feats.columns if c not in skip]


def asof_join(spine: DataFrame, lookups, spine_ts: str, bucket: str = "month", check_unique: bool = False) -> DataFrame:
    """Add the features of every lookup to each spine row, as of ``spine_ts``.

    A null key or a null time matches nothing. Feature rows should be unique
    per key and time: ``check_unique`` raises if they are not; of equal ones
    the greatest row (as a struct) counts.

    Inclusive (a feature effective at t serves an event at t). The whole latest
    row is carried as one struct, so a null inside the latest row never falls
    back to an older value. All lookups must share the same key columns; call
    once per key group to keep one shuffle per key.

    ``bucket`` (a ``date_trunc`` unit) bounds the window partitions: rows are
    partitioned by (key, bucket), so a hot key is spread over its buckets.
    """
    lookups = list(lookups)
    on = lookups[0].on
    assert all(lk.on == on for lk in lookups), "lookups in one call must share their key"
    ts_type = dict(spine.dtypes)[spine_ts]
    spine_cols = spine.columns

    parts = [spine.withColumn("_t", F.col(spine_ts)).withColumn("_side", F.lit(1))]
    for i, lk in enumerate(lookups):
        fc = lk.feature_cols()
        if check_unique:
            assert_unique(lk.feats, [*on, lk.ts])
        f = lk.feats.dropna(subset=[*on, lk.ts]).select(
            *[F.col(k) for k in on],
            F.col(lk.ts).cast(ts_type).alias("_t"),
            F.lit(0).alias("_side"),
            F.struct(*[F.col(c) for c in fc], F.col(lk.ts).cast(ts_type).alias("_fts")).alias(f"_f{i}"),
        )
        parts.append(f)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    u = u.withColumn("_b", F.date_trunc(bucket, "_t"))

    w = (Window.partitionBy(*on, "_b").orderBy("_t", "_side", *[f"_f{i}" for i in range(len(lookups))])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keep = list(dict.fromkeys(spine_cols + on + ["_b", "_side"]))
    found = u.select(*keep,
                     *[F.last(f"_f{i}", ignorenulls=True).over(w).alias(f"_g{i}") for i in range(len(lookups))])
    found = found.where("_side = 1").drop("_side")

    # carry: the last feature row of every earlier bucket, per key
    marks = spine.select(*on, F.date_trunc(bucket, F.col(spine_ts)).alias("_b")).distinct()
    for i, lk in enumerate(lookups):
        p = parts[i + 1]
        last_in_bucket = (p.withColumn("_b", F.date_trunc(bucket, "_t"))
                          .groupBy(*on, "_b").agg(F.max_by(f"_f{i}", F.struct("_t", f"_f{i}")).alias(f"_l{i}")))
        marks = marks.unionByName(last_in_bucket, allowMissingColumns=True)
    marks = marks.groupBy(*on, "_b").agg(
        *[F.first(f"_l{i}", ignorenulls=True).alias(f"_l{i}") for i in range(len(lookups))])
    wc = Window.partitionBy(*on).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = marks.select(*on, "_b", *[F.last(f"_l{i}", ignorenulls=True).over(wc).alias(f"_c{i}")
                                      for i in range(len(lookups))])

    out = found.join(carry, on=[*on, "_b"], how="left")
    sel = [F.col(c) for c in spine_cols]
    for i, lk in enumerate(lookups):
        g = F.coalesce(F.col(f"_g{i}"), F.col(f"_c{i}"))
        if lk.max_age:
            g = F.when(F.col(spine_ts) - g["_fts"] <= F.expr(f"INTERVAL {lk.max_age}"), g)
        for c in lk.feature_cols():
            sel.append(g[c].alias(lk.rename.get(c, c)))
    return out.select(*sel)


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """Key-uniqueness check for latest-value lookups; one aggregate, no collect
    of data rows (only the offending-key count reaches the driver)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"feature table is not unique on {keys}")
    return df


def lookup(spine: DataFrame, feats: DataFrame, on, names=None, check_unique: bool = False) -> DataFrame:
    """Latest-value lookup by key; a missing key gives nulls.

    Left equi join. Small feature tables are broadcast by AQE from their
    measured size; large ones take a sort-merge join, so nothing is broadcast
    without a size check.
    """
    on = [on] if isinstance(on, str) else list(on)
    if check_unique:
        assert_unique(feats, on)
    cols = names or [c for c in feats.columns if c not in on]
    return spine.join(feats.select(*on, *cols), on=on, how="left")


def enrich(df: DataFrame, dim: DataFrame, on, cols=None) -> DataFrame:
    """Left enrichment with a deduplicated dimension (unmatched rows keep nulls)."""
    on = [on] if isinstance(on, str) else list(on)
    cols = cols or [c for c in dim.columns if c not in on]
    return df.join(dim.select(*on, *cols).dropDuplicates(on), on=on, how="left")


LEVELS = 40  # blocks of 2^39 units: longer than any time span


def dyadic_blocks(lo: Column, hi: Column) -> Column:
    """The units lo .. hi (whole numbers) as few aligned blocks: array of (level, block), block * 2^level units from block << level on.

    At most two blocks of each level, so 2 log2(hi - lo + 1) in all. Each
    level gives the block that sticks out at the left and at the right, and
    the rest goes up a level.
    """
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    one = lambda level, block: F.array(F.struct(level.cast("int").alias("level"), block.cast("bigint").alias("block")))

    def step(s, level):
        open_ = s["lo"] <= s["hi"]
        left = open_ & (F.pmod(s["lo"], F.lit(2)) == 1)
        right = open_ & (F.pmod(s["hi"], F.lit(2)) == 0) & (~left | (s["hi"] > s["lo"]))
        out = F.concat(s["out"], F.when(left, one(level, s["lo"])).otherwise(none), F.when(right, one(level, s["hi"])).otherwise(none))
        up = lambda x: F.shiftright(x, 1)
        return F.struct(F.when(open_, up(s["lo"] + left.cast("bigint"))).otherwise(F.lit(1).cast("bigint")).alias("lo"),
                        F.when(open_, up(s["hi"] - right.cast("bigint") + 0)).otherwise(F.lit(0).cast("bigint")).alias("hi"), out.alias("out"))

    def guarded(s, level):
        # the pair may cross while a level is taken off; from then on nothing is open
        t = step(s, level)
        lo = s["lo"] + ((s["lo"] <= s["hi"]) & (F.pmod(s["lo"], F.lit(2)) == 1)).cast("bigint")
        right = (s["lo"] <= s["hi"]) & (F.pmod(s["hi"], F.lit(2)) == 0)
        crossed = lo > s["hi"] - right.cast("bigint")
        return F.struct(F.when(crossed, F.lit(1).cast("bigint")).otherwise(t["lo"]).alias("lo"),
                        F.when(crossed, F.lit(0).cast("bigint")).otherwise(t["hi"]).alias("hi"), t["out"].alias("out"))

    start = F.struct(lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, guarded, lambda s: s["out"])


def match_intervals(windows: DataFrame, points: DataFrame, key: str, ts: str,
                    start: str = "start_ts", end: str = "end_ts", closed: str = "both", bucket: str = "day") -> DataFrame:
    """Each window left-joined to the points with the same key and
    ``start <= ts <= end`` (closed both ends by default; ``closed="left"``
    gives the half-open form used when labels are injected).

    Time is cut into units of a ``bucket`` (hour or day) and those into
    aligned blocks of 1, 2, 4, ... units. A window is copied to the few blocks
    that cover it (two of a level at most: some 20 for ten years of days), a
    point to its block of each level that any window uses (one, if all windows
    are short), so the equi-join on (key, level, block) spreads a hot key and
    meets every pair once; never a cartesian product. A window without points
    (or with a null key or bound) comes back once, with a null p. Columns come
    back as the structs ``w`` and ``p``.
    """
    unit = {"hour": 3600, "day": 86400}[bucket]
    number = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(unit * 1_000_000)).cast("bigint")
    sane = windows.where((F.col(start) <= F.col(end)) & F.col(key).isNotNull())
    copies = sane.select(F.struct("*").alias("w"), F.col(key).alias("_k"), F.explode(dyadic_blocks(number(start), number(end))).alias("_b")) \
        .select("w", "_k", F.col("_b.level").alias("_l"), F.col("_b.block").alias("_n"))
    used = sorted(r["_l"] for r in copies.select("_l").distinct().collect())  # at most LEVELS numbers
    near = points.select(F.struct("*").alias("p"), F.col(key).alias("_pk"), number(ts).alias("_u"))
    near = near.select("p", "_pk", "_u", F.explode(F.array(*[F.lit(v) for v in used]).cast("array<int>")).alias("_pl")) \
        .withColumn("_pn", F.expr("shiftright(_u, _pl)"))
    a, b, t = F.col(f"w.{start}"), F.col(f"w.{end}"), F.col(f"p.{ts}")
    lo = (a <= t) if closed in ("both", "left") else (a < t)
    hi = (t <= b) if closed in ("both", "right") else (t < b)
    pairs = copies.join(near, (F.col("_k") == F.col("_pk")) & (F.col("_l") == F.col("_pl")) & (F.col("_n") == F.col("_pn")) & lo & hi).select("w", "p")
    # equal windows match the same points, so their key and bounds tell which had none
    had = pairs.select(F.col(f"w.{key}").alias("_hk"), a.alias("_ha"), b.alias("_hb")).distinct()
    none = windows.join(had, (F.col(key) == F.col("_hk")) & (F.col(start) == F.col("_ha")) & (F.col(end) == F.col("_hb")), "left_anti")
    return pairs.unionByName(none.select(F.struct("*").alias("w"), F.lit(None).cast(pairs.schema["p"].dataType).alias("p")))


def full_universe(keys: DataFrame, agg: DataFrame, on) -> DataFrame:
    """Distinct key universe left-joined to a recent aggregate, nulls -> 0.

    A null key is a key like any other, and stays null."""
    on = [on] if isinstance(on, str) else list(on)
    return _left(keys.select(*on).distinct(), agg, on).na.fill(0, subset=[c for c in agg.columns if c not in on])
