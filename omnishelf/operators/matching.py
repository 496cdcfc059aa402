"""Entity matching across sources without forming the pairs of a group.

A match pass pairs each left row with one right row of its key, and a history fold keeps one row per
key and source, so each key costs work linear in its rows. A key with a million copies on both sides
gives a million rows, not a million squared.

Only where the pairs of repeated rows are themselves the wanted result (``outer_unify`` with
``repeats``) are they formed, from counted rows and dealt over tasks by their number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.operators.dedupe import reduce_for_join


def _all_set(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _best_by_key(right: DataFrame, keys: Sequence[str], right_id: str) -> DataFrame:
    """(keys prefixed, right row as a struct): the row with the smallest id per complete key."""
    payload = F.struct(right_id, *[c for c in right.columns if c != right_id])
    return reduce_for_join(
        right.filter(_all_set(keys)), {f"_r_{k}": k for k in keys}, {"_found": F.min(payload)}
    )


def match_passes(
    left: DataFrame,
    right: DataFrame,
    passes: Mapping[str, Sequence[str]],
    right_id: str,
    squeeze: Callable[[DataFrame], DataFrame] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
    take: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Match in passes of falling strictness.

    ``passes`` maps a match type to its key columns, present on both sides. A row matched in one
    pass, on either side, takes no part in the later ones. Returns the left rows with ``right``
    (struct, NULL when unmatched) and ``match_type``, and the right rows that matched nothing. The
    struct holds ``right_id`` and the columns ``take``, by default all: it goes through every
    shuffle after its match.

    Of several right rows under one key the left row takes the smallest ``right_id``; all of them
    count as matched. ``squeeze`` may drop left rows between passes that cannot survive a later
    deduplication; it must keep at least one row per pass key and match state. ``store`` writes the
    state between passes and reads it back, so that a pass is not computed again for each use.
    """
    taken = [right_id, *[c for c in (right.columns if take is None else take) if c != right_id]]
    right_type = right.select(F.struct(*taken).alias("s")).schema["s"].dataType
    open_row = F.col("match_type").isNull()
    pending = left.withColumns(
        {"right": F.lit(None).cast(right_type), "match_type": F.lit(None).cast("string")}
    )
    columns = pending.columns
    rest, seen = right, pending
    for n, (match_type, keys) in enumerate(passes.items()):
        complete = _all_set(keys)
        # All columns choose the row, whichever of them are taken.
        best = _best_by_key(rest, keys, right_id).withColumn(
            "_found", F.struct(*[F.col("_found")[c].alias(c) for c in taken])
        )
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])
        # Rows without an identifier skip the first shuffle instead of meeting in one task. Later
        # passes run on squeezed rows, where a NULL key is no longer common.
        first = n == 0
        keyed = pending.filter(complete) if first else pending
        found = F.when(F.col("_found").isNotNull(), F.lit(match_type))
        joined = keyed.join(best, same & open_row, "left").select(
            *[c for c in columns if c not in ("right", "match_type")],
            F.coalesce("right", "_found").alias("right"),
            F.coalesce("match_type", found).alias("match_type"),
        )
        # Only keys are needed to take the matched rows from the right side, so this reads few
        # columns and no squeezed rows.
        used = reduce_for_join(
            seen.filter(complete & open_row), {f"_u_{k}": k for k in keys}, {}
        )
        known = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_u_{k}") for k in keys])
        rest = rest.join(used, known, "left_anti")
        pending = joined.unionByName(pending.filter(~complete)) if first else joined
        if store is not None and n + 1 < len(passes):
            pending, rest = store(pending), store(rest)
        seen = pending
        if squeeze is not None:
            pending = squeeze(pending)
    return pending, rest


def match_key(keys: Sequence[str], source: str) -> Column:
    """The key columns as one text that is never NULL.

    SQL equality pairs no NULLs, so a row with an incomplete key must stay alone: its text carries
    the source name, where a complete key has nothing. Every part tells its length, so different
    keys never give the same text.
    """

    def part(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    scope = F.when(_all_set(keys), F.lit("")).otherwise(F.lit(source))
    return F.concat_ws("|", scope, *[part(k) for k in keys])


def fold_histories(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str],
    latest: Mapping[str, str],
    totals: Mapping[str, Mapping[str, Column]] | None = None,
    base: DataFrame | None = None,
    base_name: str = "base",
    repeats: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Fold the histories of several sources into one row per key, in one shuffle.

    For each source the result has a struct column named after it: its latest row by
    ``latest[source]`` (all other columns break ties), NULL when the source lacks the key.
    ``totals[source]`` adds aggregates over all its rows as further columns. The keys of ``base``
    take part as well and set ``in_base``, which prepares ``outer_unify``. Of the sources in
    ``repeats`` only the keys take part: ``n_<source>`` counts their rows, for ``attach_repeats``,
    and ``n_base`` those of ``base``.
    """
    tagged = [
        df.select(match_key(keys, name).alias("match_key"), *keys, F.lit(True).alias(f"is_{name}"))
        for name, df in (repeats or {}).items()
    ]
    for name, df in sources.items():
        lead = latest[name]
        row = F.struct(lead, *[c for c in df.columns if c != lead and c not in keys])
        tagged.append(df.select(match_key(keys, name).alias("match_key"), *keys, row.alias(name)))
    if base is not None:
        tagged.append(
            base.select(
                match_key(keys, base_name).alias("match_key"), *keys, F.lit(True).alias("in_base")
            )
        )
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    aggregates = [F.max(c).alias(c) for c in [*keys, *sources]]
    for wanted in (totals or {}).values():
        aggregates += [c.alias(out) for out, c in wanted.items()]
    if base is not None:
        aggregates.append(F.coalesce(F.max("in_base"), F.lit(False)).alias("in_base"))
    if repeats:
        aggregates += [F.count(f"is_{name}").alias(f"n_{name}") for name in repeats]
        aggregates.append(F.count("in_base").alias("n_base"))
    aggregates.append(F.max("match_key").alias("join_key"))
    return rows.groupBy("match_key").agg(*aggregates)


def attach_repeats(
    spine: DataFrame, rows: DataFrame, name: str, keys: Sequence[str]
) -> DataFrame:
    """The spine with each of its rows as often as ``rows`` has its key, and the row as a struct.

    ``spine`` counted the rows in ``fold_histories``. It is unique on its key, so this is linear in
    ``rows``, and Spark can split a hot key. Spine rows without such a row stay, with NULL.
    """
    payload = F.struct(*[c for c in rows.columns if c not in keys]).alias(name)
    packed = rows.select(match_key(keys, name).alias("row_key"), payload)
    met = packed.join(spine.filter(f"n_{name} > 0"), F.col("row_key") == F.col("join_key"))
    alone = spine.filter(f"n_{name} = 0")
    return met.drop("row_key").unionByName(alone, allowMissingColumns=True)


# Pairs of one key that one task may make.
PAIRS_PER_TASK = 1_000_000


def numbered(df: DataFrame, store: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Rows with a number that tells repeats of a key apart and never changes: written with the row
    where ``store`` is given, else a hash of the row, which exact copies share."""
    if store is None:
        return df.withColumn("row_number", F.xxhash64(*df.columns))
    return store(df.withColumn("row_number", F.monotonically_increasing_id()))


def _parts(number: str, splits: Column, n_parts: Column) -> Column:
    """The parts of a hot key that a row goes to: its own one, or all of them."""
    every = F.sequence(F.lit(0).cast("long"), n_parts - 1)
    return F.when(splits, F.array(F.pmod(F.col(number), n_parts))).otherwise(every)


def outer_unify(
    base: DataFrame,
    name: str,
    spine: DataFrame,
    keys: Sequence[str],
    repeats: str | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Full outer join of ``base`` with a spine that ``fold_histories`` made for it.

    The base row arrives as the struct ``name``. It may repeat a key: each of its rows is kept and
    meets the one spine row of its key. As the spine knows every base key, an inner join and the
    spine rows without a base row make the outer join; Spark can split a hot partition of an inner
    join but not of a full outer join.

    With ``repeats`` the spine has been through ``attach_repeats`` for that source and every pair is
    wanted; both sides are ``numbered``. A key whose counts promise more than ``pairs_per_task``
    pairs is dealt into parts: the side with more rows by their numbers, the other copied to each.
    """
    extra = [] if repeats is None else ["row_number"]
    payload = F.struct(*[c for c in base.columns if c not in [*keys, *extra]]).alias(name)
    packed = base.select(match_key(keys, name).alias("base_key"), payload, *extra)
    # Both branches filter on in_base and keep join_key, so they share the shuffle of the fold. The
    # join uses join_key, which gets its own exchange, for the reason given in reduce_for_join.
    known = spine.filter("in_base")
    alone = spine.filter("NOT in_base AND join_key IS NOT NULL")
    same = F.col("base_key") == F.col("join_key")
    if repeats is not None:
        rows = F.greatest(F.col(f"n_{repeats}"), F.lit(1).cast("long"))
        needed = F.ceil(F.col("n_base") * rows / F.lit(pairs_per_task))
        n_parts = F.least(needed, F.greatest(F.col("n_base"), rows))
        base_splits = F.col("n_base") >= rows
        # Keys of so many pairs are few: each stands for more than pairs_per_task rows of the result.
        hot = reduce_for_join(
            known.filter(n_parts > 1).select(
                "join_key", n_parts.alias("n_parts"), base_splits.alias("base_splits")
            ),
            {"hot_key": "join_key"},
            {"n_parts": F.max("n_parts"), "base_splits": F.max("base_splits")},
        )
        whole = F.array(F.lit(0).cast("long"))
        dealt = packed.join(hot, F.col("base_key") == F.col("hot_key"), "left")
        parts = F.coalesce(_parts("row_number", F.col("base_splits"), F.col("n_parts")), whole)
        packed = dealt.select("base_key", name, F.explode(parts).alias("base_part"))
        known = known.withColumn("part", F.explode(_parts("row_number", ~base_splits, n_parts)))
        same = same & (F.col("base_part") == F.col("part"))
    met = packed.join(known, same)
    return met.unionByName(alone, allowMissingColumns=True).drop(
        "base_key", "match_key", "join_key", "in_base", "base_part", "part", "row_number",
        "n_base", f"n_{repeats}",
    )
