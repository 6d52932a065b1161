"""Training sets: buckets, ratio mixes, samples, diverse choices, quotas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType
from pyspark.sql.window import Window

from ..functions.values import closed


@dataclass(frozen=True)
class BucketConfig:
    rate_delta: float = 0.5
    bolus_delta: float = 1.0
    setup_before: float = 1.0
    setup_delta: float = 100.0
    setup_after: float = 300.0
    need_flags: bool = False
    need_evidence: bool = False


def bucket(kind: Column, key: Column, before: Column, after: Column, delta: Column, smoothed: Column, verdict: Column, has_flags: Column | None = None, has_evidence: Column | None = None, cfg: BucketConfig = BucketConfig()) -> Column:
    """Struct of bucket A, B or C and the reason; vetoes first, then active decisions, the rest is maintenance."""
    rate, volume = closed(key.endswith("_RATE")), closed(key.endswith("_VOL"))
    adjusted = closed(kind == "rate_adjustment")
    to = lambda b, r: F.struct(F.lit(b).alias("bucket"), (F.lit(r) if isinstance(r, str) else r).alias("reason"))
    reason = (
        F.when(adjusted & volume & closed(smoothed >= max(1.0, cfg.bolus_delta)), "large_volume_adjustment")
        .when(adjusted & rate & closed(F.abs(delta) >= max(1.0, 2 * cfg.rate_delta)), "large_rate_adjustment")
        .when(closed(kind == "bolus_like_event"), "bolus_like_event")
    )
    down = lambda what: to("B", F.concat(F.lit("downgraded_from_"), reason, F.lit("_missing_" + what)))
    out = (
        F.when(adjusted & rate & closed(F.abs(before) <= 1e-6), to("C", "zero_start_rate_adjustment"))
        .when(rate & closed((F.abs(before) <= cfg.setup_before) & (F.abs(delta) >= cfg.setup_delta) & (after >= cfg.setup_after)), to("C", "setup_like_rate_jump"))
        .when(volume & closed(smoothed < 0.5), to("C", "tiny_vol_background_drift"))
        .when(closed(F.lower(F.trim(verdict)) == "invalid"), to("C", "actual_validation_invalid"))
    )
    if cfg.need_flags:
        out = out.when(reason.isNotNull() & ~closed(has_flags), down("risk_flags"))
    if cfg.need_evidence:
        out = out.when(reason.isNotNull() & ~closed(has_evidence), down("objective_instability"))
    return out.when(reason.isNotNull(), to("A", reason)).otherwise(to("B", "maintenance_or_context"))


#: Hex digits of a key's head, by which keys are counted.
RANGE_DIGITS = 4


def _half_even(x: float) -> int:
    return round(x)


def mix_counts(n_a: int, n_b: int, ratio: float, most: int = 0) -> tuple[int, int]:
    """How many rows of A and B make a mix with a share of A; ``most`` 0 takes as many as the ratio allows."""
    r = min(1.0, max(0.0, ratio))
    if most <= 0:
        if r in (0.0, 1.0):
            return (n_a, 0) if r else (0, n_b)
        n = min(int(n_a / r), int(n_b / (1.0 - r)))
        a = _half_even(n * r)
        return min(a, n_a), min(n - a, n_b)
    a = min(_half_even(most * r), n_a)
    b = min(most - _half_even(most * r), n_b)
    a += min(most - a - b, n_a - a)
    return a, b + min(most - a - b, n_b - b)


def hash_order(seed: int, *ids: str) -> Column:
    """A reproducible random order: MD5 of seed and ids."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def key_counts(keyed: DataFrame, name: str, key: str) -> dict[str, list[tuple[str, int]]]:
    """By bucket, how many keys have each head, in order: summed where rows lie, for all buckets at once.

    Keys are MD5 in hex, so there are 16 ** RANGE_DIGITS heads of a bucket at most, whatever the number of rows.
    """
    out: dict[str, list[tuple[str, int]]] = {}
    head = F.left(key, F.lit(RANGE_DIGITS))
    for r in keyed.groupBy(F.col(name).alias("bucket"), head.alias("head")).count().collect():
        out.setdefault(r["bucket"], []).append((r["head"], r["count"]))
    return {b: sorted(heads) for b, heads in out.items()}


def smallest_keys(keyed: DataFrame, name: str, key: str, counts: dict[str, list[tuple[str, int]]], take: dict[str, int]) -> DataFrame:
    """Of each bucket the ``take`` rows with the smallest keys, from the counts of its keys' heads.

    The counts say in which head a bucket's cut lies; one pass over the keys of these heads finds the last key that
    comes in, and one pass over the rows compares each with its bucket's. Only rows that share that last key, where not
    all of them come in, are ranked: by their other columns, so that it is the rows that tell who comes in, not where they lie.
    """
    whole = [b for b, n in take.items() if n >= sum(c for _, c in counts.get(b, ()))]
    cuts: dict[str, tuple[str, int]] = {}
    for b, n in take.items():
        left = n
        for head, c in [] if b in whole or n <= 0 else counts[b]:
            if left <= c:
                cuts[b] = (head, left)
                break
            left -= c
    of = F.col(name)
    takes = of.isin(whole) if whole else F.lit(False)
    if not cuts:
        return keyed.filter(takes)
    inside = F.lit(False)
    for b, (head, _) in cuts.items():
        inside = inside | ((of == b) & F.startswith(F.col(key), F.lit(head)))
    w = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = keyed.filter(inside).groupBy(of.alias("bucket"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(w))
    left = F.create_map(*[F.lit(x) for b, (_, n) in cuts.items() for x in (b, n)])[F.col("bucket")]
    last = keys.filter((F.col("upto") >= left) & (F.col("upto") - F.col("n") < left)).select("bucket", "key", "n", (left - F.col("upto") + F.col("n")).alias("room")).collect()
    tied = F.lit(False)
    for r in last:
        if r["room"] == r["n"]:
            takes = takes | ((of == r["bucket"]) & (F.col(key) <= r["key"]))
        else:
            takes = takes | ((of == r["bucket"]) & (F.col(key) < r["key"]))
            tied = tied | ((of == r["bucket"]) & (F.col(key) == r["key"]))
    out = keyed.filter(takes)
    room = {r["bucket"]: r["room"] for r in last if r["room"] < r["n"]}
    if not room:
        return out
    order = [F.col(f"`{f.name}`") for f in keyed.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    ranked = keyed.filter(tied).withColumn("__n", F.row_number().over(Window.partitionBy(name).orderBy(key, *order)))
    most = F.create_map(*[F.lit(x) for b, n in room.items() for x in (b, n)])[of]
    return out.unionByName(ranked.filter(F.col("__n") <= most).drop("__n"))


def _smallest(rows: DataFrame, n: int | float, key: str) -> DataFrame:
    """The n rows with the smallest keys, which are MD5 in hex; a fraction n below 1 is max(1, int(n * rows))."""
    keyed = rows.withColumn("__all", F.lit("all"))
    counts = key_counts(keyed, "__all", key)
    total = sum(c for _, c in counts.get("all", ()))
    n = n if isinstance(n, int) else max(1, int(total * n))
    return smallest_keys(keyed, "__all", key, counts, {"all": n}).drop("__all")


def ab_mix(rows: DataFrame, ids: list[str], ratio: float, most: int = 0, seed: int = 42, name: str = "bucket") -> DataFrame:
    """Rows of buckets A and B in the ratio, each bucket's by hash order."""
    keyed = rows.filter(F.col(name).isin("A", "B")).withColumn("__key", hash_order(seed, *ids))
    counts = key_counts(keyed, name, "__key")
    take = mix_counts(*[sum(c for _, c in counts.get(b, ())) for b in "AB"], ratio, most)
    return smallest_keys(keyed, name, "__key", counts, {b: n for b, n in zip("AB", take) if n}).drop("__key")


def review_sample(rows: DataFrame, ids: list[str], rate: float, seed: int = 42) -> DataFrame:
    """max(1, int(n * rate)) rows by hash order."""
    return _smallest(rows.withColumn("__key", hash_order(seed, *ids)), float(rate), "__key").drop("__key")


def diverse(rows: DataFrame, n: int, case: str, key: str, order: str) -> DataFrame:
    """The first row of each case by case, then turns of the keys in their order, until there are n; with ``place``."""
    w = Window.partitionBy(case).orderBy(order)
    first = rows.withColumn("__c", F.row_number().over(w))
    turn = Window.partitionBy(key).orderBy(case, order)
    head = first.filter("__c = 1").withColumn("__turn", F.lit(0).cast("int")).withColumn("__k", F.lit(""))
    rest = first.filter("__c > 1").withColumn("__turn", F.row_number().over(turn)).withColumn("__k", F.col(key))
    rest = rest.filter(F.col("__turn") <= n)  # no turn beyond n can be chosen, so Spark keeps n rows a key before the shuffle
    best = head.unionByName(rest).orderBy("__turn", "__k", case, order).limit(n)
    place = F.row_number().over(Window.orderBy("__turn", "__k", case, order))  # of n rows at most
    return best.withColumn("place", place).drop("__c", "__turn", "__k")


def choose(rows: DataFrame, n: int, mode: str, case: str, key: str, order: str, seed: int = 42) -> DataFrame:
    """n rows in one of three ways: ``diverse``, the first ones (``sequential``), or by hash order (``random``)."""
    if mode == "diverse":
        return diverse(rows, n, case, key, order).drop("place")
    if mode == "sequential":
        return rows.orderBy(order).limit(n)
    if mode != "random":
        raise ValueError(f"no such way to choose: {mode}")
    return _smallest(rows.withColumn("__key", hash_order(seed, order)), n, "__key").drop("__key")


def with_quota(chosen: DataFrame, candidates: DataFrame, wanted: Column, least: int, order: str) -> DataFrame:
    """``chosen`` with its last unwanted rows replaced by the first candidates until ``least`` rows are wanted."""
    have = chosen.filter(wanted).count()
    missing = max(0, least - have)
    if not missing:
        return chosen
    new = candidates.filter(wanted).join(chosen.select(order), order, "left_anti").orderBy(order).limit(missing)
    n = new.count()
    gone = chosen.filter(~wanted).orderBy(F.desc(order)).limit(n)
    return chosen.join(gone.select(order), order, "left_anti").unionByName(new.select(*chosen.columns))


def record_summary(records: DataFrame, main_drug: str = "PPF20_VOL") -> DataFrame:
    """(name, value, n) of records with caseid, key, risk_level, kind, before and after: how many records, cases,
    records of other drugs than the main one, records like a pump's first setting, and records by key and risk level."""
    known = F.col("key").isNotNull() & ~F.col("key").isin(main_drug, "UNKNOWN", "ARR_EVENT", "UNLABELED_EVENT")
    setup = closed((F.col("kind") == "rate_adjustment") & (F.abs("before") <= 1.0) & (F.col("after") >= 300.0))
    totals = records.agg(F.count(F.lit(1)).alias("records"), F.countDistinct(F.coalesce("caseid", F.lit(-1))).alias("unique_cases"), F.count(F.when(known, 1)).alias("other_drugs"), F.count(F.when(setup, 1)).alias("setup_like"))
    one = totals.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit("").alias("value"), F.col(n).alias("n")) for n in totals.columns])).alias("t")).select("t.*")
    by = lambda name, column, none: records.groupBy(F.coalesce(column, F.lit(none)).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "value", "n")
    return one.unionByName(by("key", "key", "UNKNOWN")).unionByName(by("risk_level", "risk_level", "unknown"))
