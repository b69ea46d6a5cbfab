"""Slowly changing dimensions and the lookups that need them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators.latest import keep_latest
from quarrylake.operators.timeline import PLACES, lay_out, look_back, value_before


def _columns(names) -> list:
    return [F.col(name) for name in names]


def _changes(laid_out: DataFrame, tracked: list[str]) -> DataFrame:
    state = F.struct(*tracked)
    marked = look_back(laid_out, state, "_before")
    return marked.where(~F.col("_before").eqNullSafe(state)).drop("_before")


def drop_unchanged(
    versions: DataFrame,
    keys: list[str],
    time: str,
    tracked: list[str],
    then_by: list[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Keep only versions that differ from the version before in ``tracked``."""
    return _changes(lay_out(versions, keys, time, _columns(then_by), ranges), tracked).drop(*PLACES)


def scd2_history(
    versions: DataFrame,
    keys: list[str],
    time: str,
    then_by: list[str] = (),
    tracked: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Full history: each version is valid until the next one of its key starts.

    With ``tracked`` columns, versions that change none of them are left out.
    """
    rows = lay_out(versions, keys, time, _columns(then_by), ranges)
    if tracked:
        rows = _changes(rows, tracked)
    closed = look_back(rows, F.struct(time), "_next", latest_first=True)
    return closed.withColumns(
        {
            "valid_from": F.col(time),
            "valid_to": F.col(f"_next.{time}"),
            "is_current": F.col("_next").isNull(),
        }
    ).drop("_next", *PLACES, *([] if time == "valid_from" else [time]))


def scd2_apply(
    history: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str], time: str
) -> DataFrame:
    """Apply one batch of changes (one row per key) to a history.

    The open row of a changed key is closed at the change's time and the change
    becomes the open row. A change that says nothing new, or is not newer than the
    open row, leaves the key as it is.
    """
    closed = history.where(~F.col("is_current"))
    open_rows = history.where(F.col("is_current"))
    old = open_rows.select(*keys, F.struct(*history.columns).alias("_old"))
    new = changes.select(*keys, F.struct(*[c for c in changes.columns if c not in keys]).alias("_new"))
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))
    both = old.join(new, keys, "full_outer")
    newer = F.coalesce(F.col(f"_new.{time}") > F.col("_old.valid_from"), F.lit(False))
    replaces = F.col("_old").isNull() | (F.col("_new").isNotNull() & newer & ~same)

    def row(source):
        fields = []
        for name in history.columns:
            if source == "old":
                value = F.col(f"_old.{name}")
                if name == "valid_to":
                    value = F.when(replaces, F.col(f"_new.{time}")).otherwise(value)
                if name == "is_current":
                    value = ~replaces
            elif name in keys:
                value = F.col(name)
            elif name == "valid_from":
                value = F.col(f"_new.{time}")
            elif name == "valid_to":
                value = F.lit(None)
            elif name == "is_current":
                value = F.lit(True)
            else:
                value = F.col(f"_new.{name}")
            fields.append(value.cast(history.schema[name].dataType).alias(name))
        return F.struct(*fields)

    # one join, up to two rows per key
    rows = F.array_compact(
        F.array(F.when(F.col("_old").isNotNull(), row("old")), F.when(replaces, row("new")))
    )
    current = both.select(F.explode(rows).alias("_row")).select("_row.*")
    return closed.unionByName(current)


def scd2_merge(
    history: DataFrame,
    changes: DataFrame,
    keys: list[str],
    time: str,
    then_by: list[str] = (),
    tracked: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Work any changes into a history: late, several per key, repeated.

    A change that falls inside a version, open or closed, cuts it in two: the version ends at the
    change, and the change is valid until the version's end or the next change. One before the
    first version is valid until that one. Of rows with equal key, ``time`` and ``then_by`` the
    history's stays, so repeated changes add nothing; several equal ones count once. Only the keys
    that changed are laid out anew; the others' versions pass as they are. The result is that of
    ``scd2_history`` over all versions, if the history holds every version. NULL is a key like others.
    """
    changed = changes.select(*[F.col(name).alias(f"_c_{name}") for name in keys]).distinct()
    same_key = F.lit(True)
    for name in keys:
        same_key = same_key & history[name].eqNullSafe(changed[f"_c_{name}"])
    untouched = history.join(changed, same_key, "left_anti")
    touched = history.join(changed, same_key, "left_semi")
    attributes = [name for name in history.columns if name not in ("valid_from", "valid_to", "is_current")]
    points = touched.select(*attributes, F.col("valid_from").alias(time), F.lit(1).alias("_stored")).unionByName(
        changes.select(*attributes, time, F.lit(0).alias("_stored"))
    )
    points = keep_latest(points, [*keys, time, *then_by], ["_stored"]).drop("_stored")
    rebuilt = scd2_history(points, keys, time, then_by, tracked, ranges)
    return untouched.unionByName(rebuilt.select(history.columns))


def scd3_previous(
    versions: DataFrame,
    keys: list[str],
    time: str,
    tracked: list[str],
    then_by: list[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """One row per key: ``current_<c>`` and ``previous_<c>`` of the tracked columns.

    Previous means the value before the last change.
    """
    changes = _changes(lay_out(versions, keys, time, _columns(then_by), ranges), tracked)
    with_previous = look_back(changes, F.struct(*tracked), "_previous")
    order = F.struct(time, *then_by)
    state = F.struct(
        F.col(time).alias("current_since"),
        *[F.col(name).alias(f"current_{name}") for name in tracked],
        *[F.col(f"_previous.{name}").alias(f"previous_{name}") for name in tracked],
    )
    newest = with_previous.groupBy(*keys).agg(F.max_by(state, order).alias("_state"))
    return newest.select(*keys, "_state.*")


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    fact_time: str,
    columns: list[str],
    ranges: int | None = None,
) -> DataFrame:
    """Add the ``columns`` of the version valid at each fact's time (left join).

    Facts and versions of a key are laid on one timeline and each fact looks back
    to the last version, so no fact is paired with every version of its key.
    ``history`` must come from ``scd2_history``: valid from inclusive to exclusive.
    """
    usable = F.col(fact_time).isNotNull()
    for name in keys:
        usable = usable & F.col(name).isNotNull()
    # facts that can match nothing get a key of their own, which keeps them spread
    lone = F.when(~usable, F.xxhash64(*facts.columns))
    fact_row, version_row = F.struct(*facts.columns), F.struct("valid_to", *columns)
    points = facts.select(
        *keys, lone.alias("_lone"), F.col(fact_time).alias("_time"), F.lit(1).alias("_kind"),
        fact_row.alias("_fact"),
    ).unionByName(
        history.select(
            *keys, F.col("valid_from").alias("_time"), F.lit(0).alias("_kind"),
            version_row.alias("_version"),
        ),
        allowMissingColumns=True,
    )
    # of versions starting together, the one that stays valid comes last
    still_open = F.coalesce(F.col("_version.valid_to").isNull(), F.lit(False))
    found = value_before(
        points, [*keys, "_lone"], "_time", F.col("_version"), "_at",
        then_by=[F.col("_kind"), still_open, F.col("_version.valid_to")],
        ranges=ranges,
    ).where(F.col("_kind") == 1)
    valid = F.col("_at.valid_to").isNull() | (F.col("_time") < F.col("_at.valid_to"))
    return found.select("_fact.*", *[F.when(valid, F.col(f"_at.{c}")).alias(c) for c in columns])
