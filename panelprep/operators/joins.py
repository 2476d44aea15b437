"""Hierarchy, interval, point-in-time, routing and fallback joins.

Two rules hold throughout.  No side is broadcast by hint unless its type bounds
it, or its size was measured; and where a side's rows are repeated on the way, which
Spark's estimates of size don't count, none is broadcast at all.  And no window runs over raw rows of a key: rows are
first reduced to one per (key, day), so a key that holds a third of all rows
still gives at most one row per calendar day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from panelprep.functions.dates import parse_date
from panelprep.functions.codes import CODE_FAMILIES, UNKNOWN_FAMILY, code_family, hierarchy_key, prefix_len
from panelprep.sources.scans import distinct_dates

_EPOCH = "1970-01-01"
CIRCLE = 16  # buckets after the last start of a membership
SMALL_BYTES = 32 * 1024 * 1024  # a dictionary of so many bytes is sent to all tasks
HOT_KEYS, HOT_ROWS = 1000, 100_000  # keys that are spread, and rows that make a key hot


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _days(col: Column | str) -> Column:
    return F.datediff(col, F.lit(_EPOCH).cast("date"))


def is_small(df: DataFrame, limit: int = SMALL_BYTES) -> bool:
    """Whether the rows, written out, take at most ``limit`` bytes: measured by a job over ``df``."""
    written = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long") + 16
    return (df.agg(F.sum(written)).first()[0] or 0) <= limit


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", salts: int = 32, least: int = HOT_ROWS) -> DataFrame:
    """``left`` joined to ``right`` on equal columns, its most frequent keys spread over ``salts`` tasks each.

    One job finds the thousand most frequent keys of ``left`` with ``least`` rows or
    more; any other key has a thousandth of the rows at most.  A hot key's rows
    take turns in their salt, and the rows of ``right`` under it are repeated once
    per salt.  Rows with a null key match nothing; they take turns, too.  This
    holds whatever the session's adaptive settings are.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    found = counts.orderBy(F.col("_n").desc()).limit(HOT_KEYS).drop("_n").collect()
    if not found:
        return left.join(right, list(on), how)
    hot = left.sparkSession.createDataFrame(found, left.select(*on).schema).select(*(F.col(c).alias(f"_hot_{c}") for c in on), F.lit(True).alias("_hot"))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), _all(F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on), "left").drop(*(f"_hot_{c}" for c in on))

    turn = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    spread = marked(left).withColumn("_salt", F.when(F.col("_hot"), turn).otherwise(0)).drop("_hot")
    repeated = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return spread.join(marked(right).withColumn("_salt", F.explode(repeated)).drop("_hot"), [*on, "_salt"], how).drop("_salt")


def hierarchy_join(
    df: DataFrame, dictionary: DataFrame, level: int, code_col: str = "ind_code",
    dict_code: str = "code", dict_level: str = "levelnum",
) -> DataFrame:
    """Left join to the dictionary row of the code's level-1, 2 or 3 prefix.

    Dictionary levels are one more than visible levels.  The key is built below
    the join; the output says which level and prefix length it used.  A level of
    the dictionary that's measured to be small is sent to all tasks, so however
    many rows share a prefix, none is moved; with a larger one, frequent prefixes
    are spread (``spread_join``).
    """
    payload = [c for c in dictionary.columns if c not in (dict_code, dict_level)]
    rows = dictionary.where(F.col(dict_level) == level + 1).select(
        F.col(dict_code).alias("hierarchy_code"), *payload
    )
    keyed = df.withColumn("hierarchy_code", hierarchy_key(code_col, level))
    joined = keyed.join(F.broadcast(rows), "hierarchy_code", "left") if is_small(rows) else spread_join(keyed, rows, ["hierarchy_code"])
    return (
        joined.withColumn("hierarchy_level", F.lit(level))
        .withColumn("prefix_len", F.lit(prefix_len(level)))
    )


def hierarchy_rollup(df: DataFrame, level: int, measures: Mapping[str, str], code_col: str = "ind_code") -> DataFrame:
    """Row count and sums by hierarchy key; ``measures`` maps output name to column."""
    return (
        df.groupBy(hierarchy_key(code_col, level).alias("hierarchy_code"))
        .agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(n) for n, c in measures.items()])
        .withColumn("hierarchy_level", F.lit(level))
        .withColumn("prefix_len", F.lit(prefix_len(level)))
    )


def interval_join(
    facts: DataFrame, membership: DataFrame, key: str | Sequence[str], date: str, start: str, end: str,
    *, end_inclusive: bool, how: str = "inner", bucket_days: int = 128, bounds: tuple | None = None,
    last_start: Column | None = None,
) -> DataFrame:
    """Facts with the memberships in force on their day; a null end is open.

    ``end_inclusive`` says whether ``end`` is the last day in force or the first
    one out, and has no default because tables differ.

    The join is on (key, bucket of days): a membership is repeated once per
    bucket that it touches, a fact sits in one.  So a fact is only tested
    against its own bucket's memberships, and a hot key is spread over its
    buckets instead of landing in one task.  How far open or distant ends reach is
    read off the memberships, so the facts' plan runs once: after ``last_start``,
    the latest start of all, nothing begins any more, and the buckets from there on
    are numbered in a circle of ``CIRCLE``, over which a membership without an end
    is repeated at most that often.  ``last_start`` is a scalar, by default the
    memberships' own; give it where it can be had from less than their plan.

    With ``bounds``, a first and a last day, facts outside match nothing, and
    memberships are spread over the days between only.

    Both sides are shuffled and merged.  Memberships are repeated per bucket, facts
    are often a grid of days per key, and Spark takes such rows for as few as there
    were before: it would gather them in the driver to broadcast them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = [key] if isinstance(key, str) else list(key)
    bucket = lambda day: F.floor(_days(day) / bucket_days)
    first_day, last_day, fact_bucket = F.col(start).cast("date"), F.col(end).cast("date"), bucket(F.col(date))
    if bounds is None:
        latest = membership.select(F.max(start)).scalar() if last_start is None else last_start
        turn = bucket(latest.cast("date"))
        buckets = F.sequence(bucket(first_day), F.least(F.coalesce(bucket(last_day), turn + CIRCLE), turn + CIRCLE))
        buckets = F.when(first_day.isNotNull() & (last_day.isNull() | (first_day <= last_day)), buckets)
        fact_bucket = F.when(fact_bucket > turn, turn + 1 + (fact_bucket - turn - 1) % CIRCLE).otherwise(fact_bucket)
    else:
        low, high = (F.lit(parse_date(d)).cast("date") for d in bounds)
        first, last = bucket(F.greatest(first_day, low)), bucket(F.least(F.coalesce(last_day, high), high))
        buckets = F.when(first <= last, F.sequence(first, last))
    m = membership.withColumn("_bucket", F.explode(buckets)).alias("m")
    f = facts.withColumn("_bucket", fact_bucket).alias("f")
    day, s, e = F.col(f"f.{date}"), F.col(f"m.{start}"), F.col(f"m.{end}")
    inside = (s <= day) & (e.isNull() | ((day <= e) if end_inclusive else (day < e)))
    if bounds is not None:
        inside = inside & (day.cast("date") >= low) & (day.cast("date") <= high)
    on = _all(F.col(f"f.{k}") == F.col(f"m.{k}") for k in [*keys, "_bucket"]) & inside
    joined = f.join(m.hint("merge"), on, how)
    left = [F.col(f"f.{c}") for c in facts.columns]
    if how in ("left_semi", "left_anti"):
        return joined.select(*left)
    taken = set(facts.columns)
    return joined.select(*left, *[F.col(f"m.{c}") for c in membership.columns if c not in taken])


def interval_semantics(membership: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Evidence for ``end_inclusive``: how a key's consecutive intervals meet.

    One row.  ``next_day``: the next start is the day after the end (inclusive
    end).  ``same_day``: it's the end itself (exclusive end).  The rest are gaps
    or overlaps.  Rows whose end is before their start are only counted.
    """
    inverted = F.col(end) < F.col(start)
    valid = membership.where(F.coalesce(~inverted, F.lit(True)) & F.col(start).isNotNull())
    # Consecutive intervals in (start, end) order: within one start, all but the
    # last end are followed by the same start again.
    per_day = valid.groupBy(key, start).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(end) == F.col(start)).alias("n_zero"),
        F.count_if(F.col(end).isNull()).alias("n_open"),
        F.max(end).alias("max_end"),
    )
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    steps = per_day.select(
        "*", following.alias("next_start"),
        F.when(F.col("n_open") == 0, F.col("max_end")).alias("last_end"),
    )
    diff = F.datediff("next_start", "last_end")
    has_next = F.col("next_start").isNotNull()
    is_open = F.col("last_end").isNull()
    # Zero-length intervals that aren't the last of their start.
    zero_inner = F.col("n_zero") - F.when(F.col("last_end") == F.col(start), 1).otherwise(0)

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("long")

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    counts = steps.agg(
        total(F.col("n") - 1 + flag(has_next)).alias("transitions"),
        total(flag(has_next & (diff == 1))).alias("next_day"),
        total(zero_inner + flag(has_next & (diff == 0))).alias("same_day"),
        total(flag(has_next & (diff > 1))).alias("gaps"),
        total(F.col("n") - 1 - zero_inner + flag(has_next & (is_open | (diff < 0)))).alias("overlaps"),
    )
    return counts.select(
        "*",
        F.try_divide("next_day", "transitions").alias("inclusive_share"),
        F.try_divide("same_day", "transitions").alias("exclusive_share"),
    )


def snapshot_timeline(facts: DataFrame, key: str, ann_dt: str, period: str) -> DataFrame:
    """What was known from when: ``(key, valid_from, valid_to, snapshot)``.

    ``snapshot`` is the row of the latest period announced so far (latest
    announcement breaks ties), so a late restatement of an old period doesn't
    replace a newer period.  ``valid_to`` is exclusive, null while in force.
    """
    payload = [c for c in facts.columns if c not in (key, ann_dt, period)]
    snapshot = F.struct(period, ann_dt, *payload)
    per_day = facts.where(F.col(ann_dt).isNotNull() & F.col(period).isNotNull()).groupBy(key, ann_dt).agg(
        F.max(snapshot).alias("snapshot"))
    by_day = Window.partitionBy(key).orderBy(ann_dt)
    known = per_day.select(
        key, F.col(ann_dt).alias("valid_from"),
        F.max("snapshot").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("snapshot"),
    )
    by_from = Window.partitionBy(key).orderBy("valid_from")
    changed = known.withColumn("_prev", F.lag("snapshot").over(by_from)).where(
        ~F.col("snapshot").eqNullSafe(F.col("_prev"))
    )
    return changed.select(key, "valid_from", F.lead("valid_from").over(by_from).alias("valid_to"), "snapshot")


def point_in_time(
    queries: DataFrame, facts: DataFrame, key: str, trade_date: str = "trade_date", ann_dt: str = "ann_dt",
    period: str = "report_period", bucket_days: int = 128, bounds: tuple | None = None,
) -> DataFrame:
    """Each query row with the snapshot known on its day; null where none was.

    The facts become a timeline of validity ranges first; the large query side
    is then shuffled once, by (key, day bucket).  ``bounds`` are as in ``interval_join``.
    """
    timeline = snapshot_timeline(facts, key, ann_dt, period)
    joined = interval_join(
        queries, timeline, key, trade_date, "valid_from", "valid_to", end_inclusive=False, how="left",
        bucket_days=bucket_days, bounds=bounds, last_start=facts.select(F.max(ann_dt)).scalar(),
    )
    out = [c for c in facts.columns if c != key]
    return joined.select(*queries.columns, *[F.col(f"snapshot.{c}").alias(c) for c in out])


def as_of_universe(
    master: DataFrame, dates: DataFrame, date: str = "trade_date", start: str = "listdate",
    end: str = "delistdate", end_inclusive: bool = False, bucket_days: int = 128,
) -> DataFrame:
    """Securities listed on each date, delisted ones included while they were.

    The dates are the broadcast side (bounded by the date type), matched to each
    listing by day bucket, so the master is never shuffled.
    """
    days = F.broadcast(distinct_dates(dates, date).select(
        F.col("trade_date").alias(date), F.floor(_days("trade_date") / bucket_days).alias("_bucket")
    ))
    horizon = distinct_dates(dates, date).select(F.max("trade_date")).scalar()
    origin = distinct_dates(dates, date).select(F.min("trade_date")).scalar()
    first = F.floor(_days(F.greatest(F.col(start), origin)) / bucket_days)
    last = F.floor(_days(F.least(F.coalesce(F.col(end), horizon), horizon)) / bucket_days)
    listed = master.where(F.col(start).isNotNull()).withColumn(
        "_bucket", F.explode(F.when(first <= last, F.sequence(first, last))))
    day, e = F.col(date), F.col(end)
    inside = (F.col(start) <= day) & (e.isNull() | ((day <= e) if end_inclusive else (day < e)))
    return listed.join(days, "_bucket", "inner").where(inside).select(date, *master.columns)


def survivorship_gap(
    master: DataFrame, dates: DataFrame, date: str = "trade_date", start: str = "listdate",
    end: str = "delistdate", status: str = "list_status", listed: str = "L", end_inclusive: bool = False,
) -> DataFrame:
    """Per date: members as of then, and those a "currently listed" filter drops.

    Counted by adding up listings and delistings per day, so the universe of
    every date is never built.
    """
    off_day = F.date_add(end, 1) if end_inclusive else F.col(end)
    gone = F.when(F.coalesce(F.col(status) == listed, F.lit(False)), 0).otherwise(1)
    never = F.coalesce(off_day <= F.col(start), F.lit(False))
    rows = master.where(F.col(start).isNotNull() & ~never)
    moves = F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("sign")),
        F.struct(off_day.alias("day"), F.lit(-1).alias("sign")),
    )
    deltas = (
        rows.select(gone.alias("gone"), F.inline(moves)).where(F.col("day").isNotNull())
        .groupBy("day").agg(F.sum("sign").alias("d_all"), F.sum(F.col("sign") * F.col("gone")).alias("d_gone"))
    )
    asked = distinct_dates(dates, date).select(
        F.col("trade_date").alias("day"), F.lit(0).alias("d_all"), F.lit(0).alias("d_gone"), F.lit(1).alias("asked"))
    # One row per day from here on.
    per_day = deltas.withColumn("asked", F.lit(0)).unionByName(asked).groupBy("day").agg(
        F.sum("d_all").alias("d_all"), F.sum("d_gone").alias("d_gone"), F.max("asked").alias("asked"))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(
        F.col("day").alias(date), F.sum("d_all").over(so_far).alias("members"),
        F.sum("d_gone").over(so_far).alias("dropped"), "asked",
    ).where(F.col("asked") == 1).drop("asked")


def metadata_without_rows(meta: DataFrame, data: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Described keys that have no data row; data keys are made distinct first."""
    keys = [key] if isinstance(key, str) else list(key)
    return meta.join(data.select(*keys).distinct(), keys, "left_anti")


# Status labels seen on days with trading.
ACTIVE_LABELS = ("交易", "XD", "XR", "DR")


def tradeable(quotes: DataFrame, code: str = "tradestatuscode", suspended: int = 0) -> DataFrame:
    """Adds ``is_tradeable`` from the numeric status code, never from the label."""
    return quotes.withColumn("is_tradeable", F.col(code) != suspended)


def status_disagreement(
    quotes: DataFrame, code: str = "tradestatuscode", label: str = "tradestatus", suspended: int = 0,
    active_labels: Sequence[str] = ACTIVE_LABELS,
) -> DataFrame:
    """Rows per (code, label), and whether the two say the same."""
    return quotes.groupBy(code, label).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "agrees", (F.col(code) != suspended).eqNullSafe(F.col(label).isin(*active_labels))
    )


def suspension_check(
    suspensions: DataFrame, quotes: DataFrame, key: str, suspend_date: str = "suspend_date",
    resume_date: str = "resump_date", trade_date: str = "trade_date", is_tradeable: str = "is_tradeable",
) -> DataFrame:
    """What a null resume date means, by the quotes that follow.

    ``open_ended`` when no later day trades, ``one_day`` when the very next
    quoted day trades, else ``resumed``.  Adds ``next_trade_date`` and
    ``suspension_status``.
    """
    asked = suspensions.where(F.col(resume_date).isNull()).select(key, F.col(suspend_date).alias("_day")).distinct()
    quoted = quotes.join(asked.select(key).distinct(), key, "left_semi").select(
        key, F.col(trade_date).alias("_day"), F.lit(True).alias("_quoted"),
        F.coalesce(is_tradeable, F.lit(False)).alias("_trades"))
    days = asked.select(key, "_day", F.lit(False).alias("_quoted"), F.lit(False).alias("_trades")).unionByName(
        quoted).groupBy(key, "_day").agg(F.max("_quoted").alias("_quoted"), F.max("_trades").alias("_trades"))
    later = Window.partitionBy(key).orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = days.select(
        key, "_day",
        F.min(F.when(F.col("_quoted"), F.col("_day"))).over(later).alias("_next_quote"),
        F.min(F.when(F.col("_trades"), F.col("_day"))).over(later).alias("next_trade_date"),
    )
    status = (
        F.when(F.col(resume_date).isNotNull(), "resumed")
        .when(F.col("next_trade_date").isNull(), "open_ended")
        .when(F.col("next_trade_date") == F.col("_next_quote"), "one_day")
        .otherwise("resumed")
    )
    return (
        suspensions.withColumn("_day", F.col(suspend_date)).join(ahead, [key, "_day"], "left")
        .select(
            *suspensions.columns,
            F.when(F.col(resume_date).isNull(), F.col("next_trade_date")).alias("next_trade_date"),
            status.alias("suspension_status"))
    )


def route_by_market(
    constituents: DataFrame, quotes: Mapping[str, DataFrame], code: str = "con_code", date: str = "trade_date",
    families=CODE_FAMILIES, normalize=None,
) -> DataFrame:
    """Each constituent joined to the quotes of its own market.

    ``quotes`` maps code family to a frame with ``code``, ``date`` and measures.
    ``route`` is ``joined``, ``no_quote`` or ``unroutable``; nothing is dropped.
    Days that very many constituents share a code on are spread (``spread_join``).
    """
    norm = normalize or (lambda c: c)
    pool = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [q.withColumn("_family", F.lit(name)) for name, q in quotes.items()],
    )
    measures = [c for c in pool.columns if c not in (code, date, "_family")]
    right = pool.select(
        "_family", norm(F.col(code)).alias("_code"), F.col(date).alias("_date"), F.lit(True).alias("_hit"), *measures)
    left = constituents.withColumn("_family", code_family(code, families)).withColumn("_code", norm(F.col(code)))
    routable = F.col("_family").isin(*quotes) & (F.col("_family") != UNKNOWN_FAMILY)
    left = left.withColumn("_date", F.col(date))
    route = F.when(~routable, "unroutable").when(F.col("_hit"), "joined").otherwise("no_quote")
    return spread_join(left, right, ["_family", "_code", "_date"]).select(
        *constituents.columns, F.col("_family").alias("code_family"), route.alias("route"), *measures
    )


def first_available(sources: Sequence[tuple[str, DataFrame]], key: str | Sequence[str]) -> DataFrame:
    """Per key, the rows of the first source in order that has any; adds ``source``.

    Sources are numbered and stacked, the smallest number of each key is a partial
    aggregate, and one join back keeps its rows: each source is read twice however
    many there are, and no key's rows have to meet in one group.  The join is an
    inner one, as a semi join would be pushed into every source.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        df.withColumn("source", F.lit(name)).withColumn("_nth", F.lit(i)) for i, (name, df) in enumerate(sources)])
    first = stacked.groupBy(*keys).agg(F.min("_nth").alias("_nth"))  # one row a key
    same = _all([*(F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys), F.col("s._nth") == F.col("t._nth")])
    return stacked.alias("s").join(first.alias("t"), same).select(*(f"s.{c}" for c in stacked.columns if c != "_nth"))


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``df``, with an error in whatever job uses its rows when a key repeats; nulls are equal.

    No job of its own: rows are numbered within their key on the way, and the
    second row of a key is the error, so no key's rows are ever gathered.
    """
    keys = [key] if isinstance(key, str) else list(key)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit(f"key {keys} is not unique: "), F.to_json(F.struct(*keys)))
    return df.withColumn("_nth", nth).where(F.when(F.col("_nth") == 1, True).otherwise(F.raise_error(message).cast("boolean"))).drop("_nth")


class UniqueCheck:
    """Whether a key of some rows is unique, known once a job has used them."""

    def __init__(self, keys: list[str], observation: Observation):
        self.keys, self.observation = keys, observation

    @property
    def excess_rows(self) -> int:
        """Rows beyond the first of their key; waits for the first job over the rows."""
        return self.observation.get["excess_rows"] or 0

    def verify(self) -> None:
        if self.excess_rows:
            raise ValueError(f"key {self.keys} is not unique: {self.excess_rows} rows in excess")


def observe_unique(df: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, UniqueCheck]:
    """``df`` and a check that the first job over its rows fills in: the job itself goes on when a key repeats."""
    keys = [key] if isinstance(key, str) else list(key)
    observation = Observation(f"unique-{uuid.uuid4().hex}")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    counted = df.withColumn("_nth", nth).observe(observation, F.count_if(F.col("_nth") > 1).alias("excess_rows"))
    return counted.drop("_nth"), UniqueCheck(keys, observation)
