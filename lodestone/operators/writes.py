"""Keyed writes as joins: put, delete, conditional and partial update, selection-wide work.

A change table has the key, ``_seq`` (higher wins), and the new fields.  Each function
returns the new state as a lazy DataFrame, or a :class:`Applied` with failures beside it;
``sources.store`` writes states as versions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestone.functions.updates import FieldOp
from lodestone.operators.order import collapse

CONDITION_FAILED = 412


@dataclass
class Applied:
    """New state and the changes that were not applied: ``(id, message, status)``."""

    state: DataFrame
    errors: DataFrame


def last_wins(changes: DataFrame, key: str, seq: str = "_seq") -> DataFrame:
    """Highest ``seq`` per key.  The group limit runs before the shuffle, so a key that
    fills a third of the batch sends one row per task."""
    return collapse(changes, key, [F.col(seq).desc()])


def _split_duplicates(changes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Field operations are not idempotent: keys met twice go to the errors.

    One aggregate decides it: partial counts leave one row per key and task to shuffle.
    """
    others = [c for c in changes.columns if c != key]
    # the row kept is the only one wherever it is used
    folded = changes.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *others)).alias("_row")
    )
    single = folded.where(F.col("_n") == 1).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])
    errors = folded.where(F.col("_n") > 1).select(
        F.col(key).cast("string").alias("id"),
        F.format_string("%d updates of one document in a batch", "_n").alias("message"),
        F.lit(400).alias("status"),
    )
    return single, errors


def _failed(rows: DataFrame, key: str, message: str) -> DataFrame:
    return rows.select(
        F.col(key).cast("string").alias("id"), F.lit(message).alias("message"), F.lit(CONDITION_FAILED).alias("status")
    )


def put(base: DataFrame, changes: DataFrame, key: str, seq: str = "_seq") -> DataFrame:
    """Insert or replace whole documents.

    Untouched rows pass an anti join on the key only; with a small batch that join is a
    broadcast and the base is not shuffled at all.
    """
    last = last_wins(changes, key, seq).select(*base.columns)
    return base.join(last.select(key), key, "left_anti").unionByName(last)


def put_in_location(base: DataFrame, changes: DataFrame, key: str, location: str, value, seq: str = "_seq") -> DataFrame:
    """Put inside one location: changes addressed elsewhere and other locations' rows are left alone."""
    inside = F.col(location) == F.lit(value)
    last = last_wins(changes.where(inside), key, seq).select(*base.columns)
    replaced = last.select(F.col(key), F.col(location))
    return base.join(replaced, [key, location], "left_anti").select(*base.columns).unionByName(last)


def delete(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(ids.select(key), key, "left_anti")


def put_delete(base: DataFrame, changes: DataFrame, key: str, seq: str = "_seq", op: str = "_op") -> DataFrame:
    """A mixed change log with ``_op`` put or remove; the last operation per key counts."""
    last = last_wins(changes, key, seq)
    puts = last.where(F.col(op) != "remove").select(*base.columns)
    return base.join(last.select(key), key, "left_anti").unionByName(puts)


def put_newer(base: DataFrame, changes: DataFrame, key: str, seq: str = "_seq") -> DataFrame:
    """Put only what is newer than the stored row; the base keeps its ``_seq``.

    The result does not depend on how changes are cut into batches or in which order the
    batches come.  Tombstones stay as rows with ``_op = 'remove'``, so a late older put
    cannot bring a document back.
    """
    last = last_wins(changes, key, seq).select(*base.columns)
    held = base.select(key, F.col(seq).alias("_held")).join(last.select(key), key)
    fresh = last.join(held, key, "left").where(F.col("_held").isNull() | (F.col(seq) > F.col("_held"))).drop("_held")
    return base.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def conditional_put(
    base: DataFrame, changes: DataFrame, key: str, condition: Column, *, create_if_missing: bool = False, seq: str = "_seq"
) -> Applied:
    """Replace only documents whose stored row satisfies ``condition``.

    ``condition`` names stored columns plainly and columns of the change as ``new_<name>``.
    """
    last, met, errors = _judge(base, changes, key, condition, create_if_missing, seq)
    types = dict(base.dtypes)
    # the stored rows are read once: each is replaced, or not, where it meets its change
    new = [F.when(F.col("_ok"), F.col(f"new_{c}").cast(types[c])).otherwise(F.col(c)).alias(c) if c != key else F.col(key) for c in base.columns]
    state = met.select(*new)
    if create_if_missing:
        state = state.unionByName(last.join(base.select(key), key, "left_anti").select(*base.columns))
    return Applied(state, errors)


def conditional_delete(base: DataFrame, changes: DataFrame, key: str, condition: Column, seq: str = "_seq") -> Applied:
    _, met, errors = _judge(base, changes, key, condition, False, seq)
    return Applied(met.where(~F.col("_ok")).select(*base.columns), errors)


def _judge(base, changes, key, condition, create_if_missing, seq):
    """The last changes; every stored row with its change and whether that applies (``_ok``); the failures."""
    last = last_wins(changes, key, seq)
    new = last.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"new_{c}") for c in last.columns if c != key])
    met = base.join(new, key, "left").withColumn("_ok", F.coalesce(F.col("_hit") & condition, F.lit(False)))
    # null where the document is not stored
    verdict = last.select(key).join(_stored(base, new, key, condition), key, "left")
    failed = F.col("_ok") == F.lit(False)
    if not create_if_missing:
        failed = F.coalesce(failed, F.lit(True))
    message = F.when(F.col("_ok").isNull(), "document does not exist").otherwise("condition not met")
    errors = verdict.where(failed).select(F.col(key).cast("string").alias("id"), message.alias("message"), F.lit(CONDITION_FAILED).alias("status"))
    return last, met, errors


def _stored(base: DataFrame, changed: DataFrame, key: str, ok: Column) -> DataFrame:
    """Changed keys that are stored, with ``_ok``.  The inner join lets a small change
    table be broadcast; what comes back is no larger than it."""
    return base.join(changed, key).select(key, F.coalesce(ok, F.lit(False)).alias("_ok"))


def update_fields(
    base: DataFrame, changes: DataFrame, key: str, ops: Mapping[str, FieldOp], *, condition: Column | None = None,
    create_if_missing: bool = False,
) -> Applied:
    """Apply field operations to every document named in ``changes``.

    Operands may be ``F.col('new_<name>')``, columns of the change row.  All operations of
    a document happen in one projection.  The base side is left-joined, so a small change
    table never makes it shuffle; documents to create are found among the changes.
    """
    single, errors = _split_duplicates(changes, key)
    new = single.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"new_{c}") for c in single.columns if c != key])
    types = dict(base.dtypes)

    def applied(rows: DataFrame, ok: Column) -> DataFrame:
        return rows.select(
            *[
                F.when(ok, ops[c](F.col(c)).cast(types[c])).otherwise(F.col(c)).alias(c) if c in ops else F.col(c)
                for c in base.columns
            ]
        )

    holds = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    state = applied(base.join(new, key, "left"), F.coalesce(F.col("_hit"), F.lit(False)) & holds)
    verdict = new.join(_stored(base, new, key, holds), key, "left")
    errors = errors.unionByName(_failed(verdict.where(F.col("_ok") == F.lit(False)), key, "condition not met"))
    absent = verdict.where(F.col("_ok").isNull())
    if not create_if_missing:
        return Applied(state, errors.unionByName(_failed(absent, key, "document does not exist")))
    blank = absent.withColumns({c: F.lit(None).cast(types[c]) for c in base.columns if c != key})
    return Applied(state.unionByName(applied(blank, F.lit(True))), errors)


# -- selection-wide ------------------------------------------------------------------------------


def _selected(selection: Column) -> Column:
    return F.coalesce(selection, F.lit(False))


def update_by_selection(
    base: DataFrame, selection: Column, ops: Mapping[str, FieldOp], observation: Observation | None = None
) -> DataFrame:
    """One projection; ``observation`` reports ``affected`` once the result is written."""
    sel = _selected(selection)
    types = dict(base.dtypes)
    src = base if observation is None else base.observe(observation, F.count_if(sel).alias("affected"))
    return src.select(
        *[F.when(sel, ops[c](F.col(c)).cast(types[c])).otherwise(F.col(c)).alias(c) if c in ops else F.col(c) for c in base.columns]
    )


def delete_by_selection(base: DataFrame, selection: Column, observation: Observation | None = None) -> DataFrame:
    sel = _selected(selection)
    src = base if observation is None else base.observe(observation, F.count_if(sel).alias("affected"))
    return src.where(~sel)


def copy_by_selection(base: DataFrame, selection: Column, destination: DataFrame, key: str) -> DataFrame:
    """Matching documents are put into another store."""
    chosen = base.where(_selected(selection)).withColumn("_seq", F.lit(0))
    return put(destination, chosen, key)


def expire(base: DataFrame, selection: Column) -> DataFrame:
    """Keep only the documents an expiry selection still matches."""
    return base.where(_selected(selection))


# -- bulk feed -------------------------------------------------------------------------------------


def feed_summary(total: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: total, success and failure counts, success rate."""
    n = total.agg(F.count(F.lit(1)).alias("total"))
    failed = errors.agg(F.count(F.lit(1)).alias("failure"))
    return n.select("total", failed.scalar().alias("failure")).select(
        "total",
        (F.col("total") - F.col("failure")).alias("success"),
        "failure",
        F.coalesce(F.try_divide(F.col("total") - F.col("failure"), F.col("total")), F.lit(0.0)).alias("success_rate"),
    )


def bulk_put(
    base: DataFrame, changes: DataFrame, key: str, *, valid: Column | None = None, condition: Column | None = None,
    create_if_missing: bool = True, conditions: Mapping[str, Column] | None = None,
) -> Applied:
    """Put a whole change table; every change that is not ``valid`` or misses its condition is an error of its own.

    ``condition`` holds for all documents; with ``conditions`` each change names one in its column ``condition``, null for none.  Conditions
    see stored columns plainly and those of the change as ``new_<name>``.
    """
    good, bad = changes, []
    ident = F.col(key).cast("string").alias("id")

    def refuse(rows: DataFrame, message: str) -> None:
        bad.append(rows.select(ident, F.lit(message).alias("message"), F.lit(400).alias("status")))

    if valid is not None:
        ok = _selected(valid)
        good = good.where(ok)
        refuse(changes.where(~ok), "invalid document")
    if conditions is not None:
        known = F.col("condition").isNull() | F.col("condition").isin(list(conditions))
        refuse(good.where(~known), "unknown condition")
        good = good.where(known)
        for name, c in conditions.items():
            held = F.when(F.col("new_condition") == name, F.coalesce(c, F.lit(False))).otherwise(F.lit(True))
            condition = held if condition is None else condition & held
    if condition is None:
        out = Applied(put(base, good, key), base.sparkSession.createDataFrame([], "id string, message string, status int"))
    else:
        out = conditional_put(base, good, key, condition, create_if_missing=create_if_missing)
        # a document's earlier changes in the batch fail with the one that was judged
        out = Applied(out.state, good.select(ident).join(out.errors, "id").select("id", "message", "status"))
    for rows in bad:
        out = Applied(out.state, out.errors.unionByName(rows))
    return out


def bulk_delete(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return delete(base, ids, key)
