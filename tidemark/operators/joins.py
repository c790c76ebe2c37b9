"""Join shapes that recur in the marts.

Nothing here forces a broadcast: dimension files carry their size in the plan,
so Catalyst broadcasts the small ones itself and falls back to a shuffle join,
which adaptive execution splits where a key is frequent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import along_key, last_seen, ordinal, running_sum
from tidemark.operators.skew import HOT_ROWS, parts_for
from tidemark.sources.lake import store


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    return df.join(other, _on(on), "left_semi")


def exclude(
    df: DataFrame, other: DataFrame, on: str | Sequence[str], null_aware: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``.

    ``null_aware`` gives the SQL ``NOT IN`` meaning for one key: no rows at all
    when the list holds a NULL, and NULL keys are dropped unless the list is empty.
    """
    keys = _on(on)
    if not null_aware:
        return df.join(other, keys, "left_anti")
    (key,) = keys
    facts = other.agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(key).isNull()).alias("_nulls")
    )
    kept = df.join(other.where(F.col(key).isNotNull()), keys, "left_anti")
    empty = facts.select("_n").scalar() == 0
    return kept.where(empty | ((facts.select("_nulls").scalar() == 0) & F.col(key).isNotNull()))


def flag_in(df: DataFrame, other: DataFrame, on: str | Sequence[str], flag: str) -> DataFrame:
    """Add a boolean: does the key occur in ``other``?"""
    keys = _on(on)
    listed = other.select(*keys).distinct().withColumn(flag, F.lit(True))
    return df.join(listed, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]]
) -> DataFrame:
    """Left-join dimensions: each entry is (dim, fact key, dim key, {dim column: output name}).

    The same dimension may appear several times under different fact keys.
    """
    out = fact
    for dim, fact_key, dim_key, take in dims:
        slim = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(n) for c, n in take.items()])
        out = out.join(slim, out[fact_key] == slim["_dk"], "left").drop("_dk")
    return out


def or_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], take: Mapping[str, str]
) -> DataFrame:
    """Left join on ``a1 = b1 OR a2 = b2 ...`` as one equi join per alternative.

    An OR condition would be a nested loop.  A pair of rows that several
    alternatives match comes back once, by the first of them.
    """
    values = [F.col(c).alias(n) for c, n in take.items()]
    keys = [F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(pairs)]
    found, lonely = [], left
    for i, (a, _) in enumerate(pairs):
        alt = right.select(*keys, *values)
        hit = left.join(alt, left[a] == alt[f"_k{i}"])
        for j, (earlier, _) in enumerate(pairs[:i]):
            hit = hit.where(~F.coalesce(F.col(earlier) == F.col(f"_k{j}"), F.lit(False)))
        found.append(hit.select(*left.columns, *take.values()))
        lonely = lonely.join(right.select(keys[i]), F.col(a) == F.col(f"_k{i}"), "left_anti")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [*found, lonely])


def asof_validity(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    start: str,
    version_id: str,
    take: Mapping[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach the version in force at each event: the last one with start <= event time.

    A version is valid on the half-open interval [start, next start); of two
    versions with one start the greater ``version_id`` counts.  Events and
    versions are laid on one time line and the last version is carried forward,
    so there is no range join and there are no pairs.  A NULL key or start never
    matches, as in a join.
    """
    keys = list(keys)
    payload = F.struct(*[F.col(c).alias(n) for c, n in take.items()])
    begun = versions.where(_all_known([*keys, start])).select(
        *keys,
        F.col(start).alias("_ts"),
        F.lit(0).alias("_side"),
        F.col(version_id).alias("_vid"),
        payload.alias("_version"),
    )
    asked = events.select(
        *keys, F.col(event_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct("*").alias("_event")
    )
    line = begun.unionByName(asked, allowMissingColumns=True)
    seen = along_key(line, keys, ["_ts", "_side", "_vid"], {"_valid": last_seen("_version")}, hot_rows=hot_rows)
    return seen.where(F.col("_side") == 1).select(
        "_event.*", *[F.col("_valid").getField(n).alias(n) for n in take.values()]
    )


def newest_inside(
    spans: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    event_ts: str,
    event_id: str,
    take: Mapping[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach to each span the newest event of its key that lies inside it, both ends included.

    That is the last event up to the span's end, if it is not before its start: one time line, no pairs.  Of
    events at one time the greatest ``event_id`` counts; spans without a key or an end, or without an event
    inside, get NULLs.
    """
    dated = events.withColumn("_at", F.col(event_ts))
    found = asof_validity(spans, dated, keys, end, event_ts, event_id, {**take, "_at": "_at"}, hot_rows)
    inside = F.col("_at") >= F.col(start)
    return found.select(*spans.columns, *[F.when(inside, F.col(n)).alias(n) for n in take.values()])


def asof_first(
    anchors: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    anchor_ts: str,
    event_ts: str,
    event_id: str,
    take: Mapping[str, str],
    days: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach to each anchor the first event of its key on its day or later, at most ``days`` days after it.

    Time line as in ``asof_validity``, walked from its end, so the event seen last is the one that comes next.  Of
    events at one time the smallest ``event_id`` counts.  A NULL key or time never matches.
    """
    keys = list(keys)
    payload = F.struct(F.to_date(event_ts).alias("_on"), *[F.col(c).alias(n) for c, n in take.items()])
    come = events.where(_all_known([*keys, event_ts])).select(
        *keys,
        F.to_date(event_ts).alias("_day"),
        F.lit(1).alias("_side"),
        F.col(event_ts).alias("_ts"),
        F.col(event_id).alias("_eid"),
        payload.alias("_event"),
    )
    asked = anchors.select(*keys, F.to_date(anchor_ts).alias("_day"), F.lit(0).alias("_side"), F.struct("*").alias("_anchor"))
    line = come.unionByName(asked, allowMissingColumns=True)
    order = ["_day", "_side", "_ts", "_eid"]
    seen = along_key(line, keys, order, {"_next": last_seen("_event")}, descending=True, hot_rows=hot_rows)
    away = F.datediff(F.col("_next._on"), F.col("_day"))
    near = away >= 0 if days is None else away.between(0, days)
    return seen.where(F.col("_side") == 0).select(
        "_anchor.*", *[F.when(near, F.col("_next").getField(n)).alias(n) for n in take.values()]
    )


def tiered_match(
    df: DataFrame,
    targets: DataFrame,
    tiers: Sequence[tuple[str, Sequence[Column], Sequence[Column]]],
    take: Mapping[str, str],
    tier_col: str = "match_tier",
    rivals_col: str = "rivals",
) -> DataFrame:
    """Match each row with a target by the first tier of keys that only one target has.

    A tier is (name, keys of ``df``, keys of ``targets``), best first.  A key that several targets share decides
    nothing, so the row goes on to the next tier; ``rivals`` says how many shared such a key at most (0: none did).
    Rows that no tier matches keep NULLs.  Targets become one row per key before each join, so no key multiplies rows.
    """
    out, names = df.select(F.struct("*").alias("_row"), "*"), list(take.values())
    payload = F.struct(*[F.col(c).alias(n) for c, n in take.items()])
    hit, passed, rivals = None, F.lit(True), [F.lit(0).cast("long")]
    for i, (name, own, theirs) in enumerate(tiers):
        right = [c.alias(f"_t{i}_{j}") for j, c in enumerate(theirs)]
        keyed = targets.select(*right, payload.alias("_p"))
        keyed = keyed.where(_all_known([f"_t{i}_{j}" for j in range(len(theirs))]))
        single = keyed.groupBy(*[f"_t{i}_{j}" for j in range(len(theirs))]).agg(
            F.count(F.lit(1)).alias(f"_n{i}"), F.min("_p").alias(f"_p{i}")
        )
        left = [c.alias(f"_l{i}_{j}") for j, c in enumerate(own)]
        out = out.select("*", *left).join(
            single, reduce(lambda a, b: a & b, [F.col(f"_l{i}_{j}") == F.col(f"_t{i}_{j}") for j in range(len(own))]), "left"
        )
        found = F.coalesce(F.col(f"_n{i}") == 1, F.lit(False))
        entry = F.struct(F.lit(name).alias("tier"), F.col(f"_p{i}").alias("target"))
        hit = F.when(found, entry) if hit is None else hit.when(found, entry)
        passed = passed & ~found
        rivals.append(F.when(passed & (F.col(f"_n{i}") > 1), F.col(f"_n{i}")).otherwise(0))
    most = F.greatest(*rivals).alias(rivals_col)
    return out.select("_row", hit.alias("_hit"), most).select(
        "_row.*", *[F.col("_hit.target").getField(n).alias(n) for n in names], F.col("_hit.tier").alias(tier_col), rivals_col
    )


def _per_day(rows: DataFrame, keys: Sequence[str], parts: int, facts: Mapping[str, Column]) -> DataFrame:
    """Facts of the rows of a key and day, in up to 16 parts of them, which the caller adds up.

    The rows are spread by all their columns first, so that no task groups more than its part of them and those of
    a frequent key become few before they meet.
    """
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(16)))
    spread = spread.repartition(parts, *keys, "_day", "_salt").groupBy(*keys, "_day", "_salt")
    return spread.agg(*[c.alias(n) for n, c in facts.items()]).drop("_salt")


def lookback_counts(
    grid: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    ref_date: str,
    event_date: str,
    days: int,
    conditions: Mapping[str, Column],
) -> DataFrame:
    """Per (key, reference date): events in [reference - days, reference] under each condition.

    Events are first counted per key and day; each grid row then asks the
    running total at the two ends of its window.  Work is linear in the number
    of rows, whatever the window length or key frequency.  One row comes back
    per distinct (key, reference date).
    """
    keys, names = list(keys), list(conditions)
    known = events.where(_all_known(keys)).select(
        *keys, F.col(event_date).alias("_day"), *[c.cast("boolean").alias(n) for n, c in conditions.items()]
    )
    points = grid.select(*keys, F.col(ref_date).alias("_ref"))
    parts = parts_for(known.count() + 2 * points.count())
    daily = _per_day(known, keys, parts, {n: F.count_if(n) for n in names})
    asked = points.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.date_sub("_ref", days).alias("_day"), F.lit(0).alias("_side")),
                F.struct(F.col("_ref").alias("_day"), F.lit(2).alias("_side")),
            )
        ).alias("_p"),
    ).select(*keys, "_ref", "_p.*")
    line = daily.withColumn("_side", F.lit(1)).unionByName(asked, allowMissingColumns=True).repartition(parts, *keys)
    line = line.groupBy(*keys, "_day", "_side", "_ref").agg(*[F.sum(n).alias(n) for n in names])
    # at most a few rows per key and day, so the window groups are bounded
    steps = {f"_r_{n}": running_sum(n) for n in names}
    totals = along_key(line, keys, ["_day", "_side", "_ref"], steps, hot_rows=None)
    sign = F.when(F.col("_side") == 2, 1).otherwise(-1)
    return (
        totals.where(F.col("_side") != 1)
        .groupBy(*keys, F.col("_ref").alias(ref_date))
        .agg(*[F.coalesce(F.sum(sign * F.col(f"_r_{n}")), F.lit(0)).alias(n) for n in names])
    )


def asof_last(
    grid: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    ref_date: str,
    event_ts: str,
    out: str,
) -> DataFrame:
    """Per (key, reference date): the last event time on or before the reference date."""
    keys = list(keys)
    days = events.where(_all_known(keys)).select(*keys, F.to_date(event_ts).alias("_day"), F.col(event_ts).alias("_ts"))
    points = grid.select(*keys, F.col(ref_date).alias("_day"), F.lit(1).alias("_side"))
    parts = parts_for(days.count() + points.count())
    daily = _per_day(days, keys, parts, {"_ts": F.max("_ts")}).withColumn("_side", F.lit(0))
    line = daily.unionByName(points, allowMissingColumns=True).repartition(parts, *keys)
    line = line.groupBy(*keys, "_day", "_side").agg(F.max("_ts").alias("_ts"))
    seen = along_key(line, keys, ["_day", "_side"], {out: last_seen("_ts")}, hot_rows=None)
    return seen.where(F.col("_side") == 1).select(*keys, F.col("_day").alias(ref_date), out)


def recurrence(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    row_id: str,
    days: int,
    count_col: str = "previous",
    last_col: str = "last_id",
) -> DataFrame:
    """Add how many rows of the key fall in the ``days`` days before, and the newest one's id.

    ``row_id`` must be unique; rows of the same day do not count.
    """
    keys = list(keys)
    daily = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_n"), F.max(row_id).alias("_id"))
    # one row per key and day, so a frame holds at most ``days`` rows
    back = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    facts = daily.select(
        *keys,
        day,
        F.coalesce(F.sum("_n").over(back), F.lit(0)).alias(count_col),
        F.last("_id").over(back).alias(last_col),
    )
    return df.join(facts, [*keys, day], "left").withColumn(count_col, F.coalesce(count_col, F.lit(0)))


def pair_positionally(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    a_order: Sequence[str],
    b_order: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join the n-th row of ``a`` with the n-th row of ``b`` per key."""
    left = along_key(a, keys, a_order, {"position": ordinal()}, hot_rows=hot_rows)
    right = along_key(b, keys, b_order, {"position": ordinal()}, hot_rows=hot_rows)
    return left.join(right, [*keys, "position"], how)


def contains_join(
    df: DataFrame, text: str, needles: DataFrame, needle: str, take: Sequence[str], gram: int = 8
) -> DataFrame:
    """Rows of ``df`` with each needle whose text occurs inside ``text``.

    Texts and needles meet on character n-grams, as wide as the needle but no
    wider than ``gram``.  A needle is looked up by the one of its grams that the
    fewest texts hold, then verified in the text itself.  The grams of the
    needles are stored tables whose size Catalyst knows, so where they are few
    enough to be broadcast the grams of the texts are counted and dropped where
    they are made; what is shuffled is texts, once, and a hash for each needle
    that one may hold.
    """
    cols = list(dict.fromkeys([needle, *take]))
    usable = needles.where(F.length(needle) > 0).select(*cols).withColumn("_needle", F.struct(*cols))
    own = F.when(F.length(needle) < gram, F.array(needle)).otherwise(_runs(needle, gram))
    width = F.least(F.length(needle), F.lit(gram)).alias("_width")
    asked = store(usable.select("_needle", width, F.explode(F.array_distinct(own)).alias("_gram")), "needle-grams")
    # no more than ``gram`` numbers
    widths = sorted(r[0] for r in asked.select("_width").distinct().collect()) or [gram]
    keyed = df.where(F.length(text) > 0).withColumn("_text", F.unhex(F.sha2(F.col(text).cast("binary"), 256)))
    made = F.array_distinct(F.concat(*[_runs(text, n) for n in widths]))
    held = keyed.select("_text", F.explode(made).alias("_gram"))
    spread = held.join(asked.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a needle with a gram that no text holds is nowhere; so all its grams must be counted
    rarest = asked.join(spread, "_gram", "left").groupBy("_needle").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_r")
    ).where("_r.n > 0").select("_needle", F.col("_r._gram").alias("_gram"))
    # rows with equal texts are candidates together
    maybe = held.join(store(rarest, "needle-rarest"), "_gram").select("_text", "_needle").distinct()
    hit = keyed.join(maybe, "_text").where(F.contains(F.col(text), F.col("_needle").getField(needle)))
    names = [c for c in take if c not in df.columns]
    return hit.select(*df.columns, *[F.col("_needle").getField(c).alias(c) for c in names])


def _runs(text: str, width: int) -> Column:
    """All runs of ``width`` characters of a text, overlapping; none of a shorter one."""
    return F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1))
