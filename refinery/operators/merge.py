"""Merges as DataFrame compositions.

The usual case is a small batch against a large table, so every plan keeps
the table on the streamed side of its join: the batch (or its keys) is the
build side. Callers cache the batch first
(``joins.measured``), so the planner knows its bytes and picks broadcast or shuffle.

* new table after an upsert:  ``table ANTI JOIN batch.keys  UNION  batch``
* change rows of an upsert:   ``table SEMI/INNER JOIN batch`` (matched rows,
  at most one per batch row) and ``batch ANTI JOIN matched.keys`` (inserts)
* new table after a delete:   ``table ANTI JOIN keys``
* change rows of a delete:    ``table SEMI JOIN keys``
"""

from __future__ import annotations

from collections.abc import Sequence
import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from refinery.functions.stamps import now_or
from refinery.operators.latest import latest_per_key, order_columns

# The change types of a row-level change feed.
INSERT = "insert"
UPDATE_PRE = "update_preimage"
UPDATE_POST = "update_postimage"
DELETE = "delete"
CHANGE_TYPES = (INSERT, UPDATE_PRE, UPDATE_POST, DELETE)
CHANGE_TYPE = "_change_type"


class MergeError(ValueError):
    pass


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def duplicate_or_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or contain a NULL (partial aggregate per key)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | _any_null(keys)))


def require_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> int:
    """Refuse a merge source with duplicate or NULL keys: it would be ambiguous.

    One aggregate job (partial counts per key); returns the number of rows.
    """
    if not keys:
        raise MergeError("a merge needs at least one key column")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    _any_null(keys).alias("null_key"))
    row = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                      F.coalesce(F.max("n"), F.lit(0)).alias("max_n"),
                      F.coalesce(F.max(F.col("null_key").cast("int")), F.lit(0)).alias("nulls")
                      ).first()
    if row["max_n"] > 1 or row["nulls"]:
        raise MergeError(f"{what} has duplicate or NULL values of key {list(keys)}")
    return int(row["rows"])


def align(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise MergeError(f"source lacks columns {missing}")
    return source.select(*columns)


def upsert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K4: matched rows replaced by the source row, others inserted, none deleted."""
    src = align(source, target.columns)
    return target.join(src.select(*keys), list(keys), "left_anti").unionByName(src)


def full_outer_merge(target: DataFrame, latest: DataFrame, keys: Sequence[str],
                     newer: Sequence[str] = (), wins: Observation | None = None) -> DataFrame:
    """K6 for a source as large as the target: source rows replace or join the target's.

    One full outer join on the key. ``latest`` has unique keys and its plan may already be
    partitioned by them (latest-per-key), which the join then uses; keys are not NULL. With
    ``newer`` a stored row only gives way to one that is not older in these columns (nulls
    lowest, as in :func:`newer_rows`). ``wins`` counts the source rows taken (``n``).
    """
    cols = target.columns
    old = target.select(*keys, F.struct(*cols).alias("_old"))
    new = align(latest, cols).select(*keys, F.struct(*cols).alias("_new"))
    taken = F.col("_new").isNotNull()
    if newer:
        def of(side: str) -> Column:
            return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in newer])
        taken = taken & (F.col("_old").isNull() | (of("_new") >= of("_old")))
    rows = old.join(new, list(keys), "full_outer").select(
        F.when(taken, F.col("_new")).otherwise(F.col("_old")).alias("_row"), taken.alias("_taken"))
    if wins is not None:
        rows = rows.observe(wins, F.count_if("_taken").alias("n"))
    return rows.select("_row.*")


def delete_frame(target: DataFrame, keys: Sequence[str] | None = None,
                 keys_df: DataFrame | None = None, condition: str | Column | None = None) -> DataFrame:
    """K5: drop the rows whose key is in ``keys_df``, or where ``condition`` is true.

    A NULL condition keeps the row (SQL ``DELETE ... WHERE`` semantics).
    """
    if keys_df is not None:
        return target.join(keys_df.select(*keys), list(keys), "left_anti")
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return target.where(~F.coalesce(cond, F.lit(False)))


def _typed(struct_col: str, change_type: str) -> Column:
    return F.struct(F.lit(change_type).alias(CHANGE_TYPE), F.col(struct_col).alias("row"))


def _flatten(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"c.row.{c}").alias(c) for c in columns],
                     F.col(f"c.{CHANGE_TYPE}").alias(CHANGE_TYPE))


def matched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored and incoming row of every batch key already in the table (``_old``, ``_new``).

    One scan of the table against the (broadcast) batch; at most one row per
    batch row, so a caller may persist it to serve both feed branches.
    """
    cols = target.columns
    src = align(source, cols)
    old = target.select(*keys, F.struct(*cols).alias("_old"))
    new = src.select(*keys, F.struct(*cols).alias("_new"))
    return old.join(new, list(keys), "inner")


def upsert_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], matched: DataFrame | None = None) -> DataFrame:
    """F1 for an upsert: ``insert`` for new keys, pre/post images for changed rows.

    A matched row equal to its source row (null-safe, all columns) is silent.
    ``matched`` (from :func:`matched_rows`, ideally persisted) saves a second
    scan of the table.
    """
    cols = target.columns
    src = align(source, cols)
    new = src.select(*keys, F.struct(*cols).alias("_new"))
    if matched is None:
        matched = matched_rows(target, source, keys)
    updates = (matched.where(~F.col("_old").eqNullSafe(F.col("_new")))
               .select(F.explode(F.array(_typed("_old", UPDATE_PRE),
                                         _typed("_new", UPDATE_POST))).alias("c")))
    inserts = (new.join(matched.select(*keys), list(keys), "left_anti")
               .select(_typed("_new", INSERT).alias("c")))
    return _flatten(updates.unionByName(inserts), cols)


def delete_changes(target: DataFrame, keys: Sequence[str] | None = None,
                   keys_df: DataFrame | None = None, condition: str | Column | None = None) -> DataFrame:
    """F1 for a delete: one ``delete`` row per removed row."""
    if keys_df is not None:
        gone = target.join(keys_df.select(*keys), list(keys), "left_semi")
    else:
        cond = F.expr(condition) if isinstance(condition, str) else condition
        gone = target.where(F.coalesce(cond, F.lit(False)))
    return gone.withColumn(CHANGE_TYPE, F.lit(DELETE))


def diff_changes(old: DataFrame, new: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """F1 between two table states.

    With keys: one full outer join on the keys; unchanged rows are silent,
    updates give pre and post images, missing rows give insert or delete.
    Without keys: multiset difference both ways (``EXCEPT ALL``).
    """
    cols = old.columns
    new = align(new, cols)
    if not keys:
        gone = old.exceptAll(new).withColumn(CHANGE_TYPE, F.lit(DELETE))
        came = new.exceptAll(old).withColumn(CHANGE_TYPE, F.lit(INSERT))
        return gone.unionByName(came)
    o = old.select(*keys, F.struct(*cols).alias("_old"))
    n = new.select(*keys, F.struct(*cols).alias("_new"))
    j = o.join(n, list(keys), "full_outer")
    change = (
        F.when(F.col("_old").isNull(), F.array(_typed("_new", INSERT)))
        .when(F.col("_new").isNull(), F.array(_typed("_old", DELETE)))
        .when(~F.col("_old").eqNullSafe(F.col("_new")),
              F.array(_typed("_old", UPDATE_PRE), _typed("_new", UPDATE_POST)))
    )
    return _flatten(j.select(F.explode(change).alias("c")), cols)


def newer_rows(target: DataFrame, latest: DataFrame, keys: Sequence[str], order: Sequence[str],
               skip: Sequence[str] = ()) -> DataFrame:
    """Rows of ``latest`` (one per key) that are not older than the stored row of their key.

    Rows are compared by the same whole order as in ``latest_per_key``: ``order`` first, then
    every other column (but for ``skip``, e.g. a promotion stamp), nulls lowest. Only the
    target's rows of these keys are kept; the batch is the build side.
    """
    cols = [c for c in order_columns(latest, keys, order) if c not in skip]
    stored = (target.join(latest.select(*keys), list(keys), "left_semi")
              .select(*keys, F.struct(*cols).alias("_stored")))
    return (latest.join(stored, list(keys), "left")
            .where(F.col("_stored").isNull() | (F.struct(*cols) >= F.col("_stored")))
            .drop("_stored"))


def full_merge_frame(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                     order: str | Sequence[str], stamp_col: str = "_silver_modified_at",
                     stamp: dt.datetime | None = None, delete_missing: bool = False) -> DataFrame:
    """K6: latest source row per key (W1, total order), stamped, upserted into target.

    Target keys absent from the source are kept unless ``delete_missing``
    (then the result is exactly the source's latest rows).
    """
    order = [order] if isinstance(order, str) else list(order)
    latest = latest_per_key(source, keys, order).withColumn(stamp_col, now_or(stamp))
    if target is None or delete_missing:
        return latest if target is None else align(latest, target.columns)
    return upsert_frame(target, latest, keys)


# The operations of a change record.
OPERATIONS = ("I", "U", "D")


def change_fault(keys: Sequence[str], op_col: str = "op_type") -> Column:
    """Why a change record cannot be applied, or NULL."""
    return (F.when(_any_null(keys), "null key").when(F.col(op_col).isNull(), "no operation")
            .when(~F.upper(F.trim(F.col(op_col))).isin(*OPERATIONS), "unknown operation"))


def valid_changes(changes: DataFrame, keys: Sequence[str], op_col: str = "op_type") -> DataFrame:
    """Change records that can be applied; callers quarantine the others (``change_fault``)."""
    return changes.where(change_fault(keys, op_col).isNull())


def fold_changes(changes: DataFrame, keys: Sequence[str], data: Sequence[str], seq_col: str, op_col: str) -> DataFrame:
    """Change records folded to one row per key: keys, ``_last`` (the record of the highest
    sequence, as a struct) and per data column ``_w_<column>`` = (sequence, value) of the
    highest sequence that carried one.

    An insert or update carries every column, NULL included; a delete carries those that it
    fills. Records of one sequence are told apart by all their columns, so the fold does not
    depend on the order of arrival. One aggregate with partial results before the shuffle.
    """
    is_del = F.upper(F.trim(F.col(op_col))) == "D"
    order = F.struct(F.col(seq_col), *[F.col(c) for c in order_columns(changes, keys, [seq_col])[1:]])
    record = F.struct(*[F.col(c) for c in changes.columns])
    aggs = [F.max_by(record, order).alias("_last")]
    for c in data:
        carried = F.when(~is_del | F.col(c).isNotNull(), order)
        aggs.append(F.max_by(F.struct(F.col(seq_col).alias("seq"), F.col(c).alias("value")), carried).alias(f"_w_{c}"))
    return changes.groupBy(*keys).agg(*aggs)


def cdc_merge_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                   seq_col: str = "_seq", op_col: str = "op_type",
                   deleted_col: str = "is_deleted", time_col: str | None = None,
                   deleted_at_col: str = "deleted_at", columns_col: str = "_column_seq") -> DataFrame:
    """K7: the rows a CDC batch writes into a soft-delete table.

    ``changes`` carries the data columns, ``op_col`` in I/U/D and a sequence ``seq_col``;
    ``target`` carries the data columns, ``seq_col``, ``deleted_col`` and ``columns_col``. The
    record of the highest sequence says whether a row is deleted. An insert or update
    replaces the row; a delete keeps it: each column has the value of the highest sequence that
    carried one, so a delete with only its key keeps what is known, and an older record that
    arrives after it still fills what it left open. ``columns_col`` (map, NULL on live rows)
    remembers those sequences, which makes the result independent of the order in which records
    and batches arrive (without that column a tombstone's values all count as its own). A later insert or update revives the row. When the target has
    ``deleted_at_col`` and the changes carry ``time_col``, a delete stamps its time there.
    Records of a sequence that is already applied change nothing.
    """
    stamped = time_col is not None and deleted_at_col in target.columns
    skip = (seq_col, deleted_col, columns_col) + ((deleted_at_col,) if stamped else ())
    changes = valid_changes(changes, keys, op_col)
    data = [c for c in target.columns if c not in skip and c not in keys]
    folded = fold_changes(changes, keys, data, seq_col, op_col)
    stored = (target.join(folded.select(*keys), list(keys), "left_semi")
              .select(*keys, F.struct(*target.columns).alias("_t")))
    j = folded.join(stored, list(keys), "left")
    newer = F.col("_t").isNull() | (F.col(f"_last.{seq_col}") > F.col(f"_t.{seq_col}"))
    is_del = F.when(newer, F.upper(F.trim(F.col(f"_last.{op_col}"))) == "D").otherwise(F.col(f"_t.{deleted_col}"))
    remembers = columns_col in target.columns
    writers, fills = {}, F.lit(False)
    for c in data:
        # a live row's columns are all of its own sequence; a tombstone's are in its map
        held = F.col(f"_t.{seq_col}")
        if remembers:
            held = F.when(F.coalesce(F.col(f"_t.{deleted_col}"), F.lit(False)), F.col(f"_t.{columns_col}")[c]).otherwise(held)
        mine = F.col(f"_w_{c}.seq")
        wins = mine.isNotNull() & (held.isNull() | (mine > held))
        fills = fills | wins
        writers[c] = (F.when(wins, mine).otherwise(held), F.when(wins, F.col(f"_w_{c}.value")).otherwise(F.col(f"_t.{c}")))
    out = [F.col(k) for k in keys]
    out += [value.alias(c) for c, (_, value) in writers.items()]
    out += [F.when(newer, F.col(f"_last.{seq_col}")).otherwise(F.col(f"_t.{seq_col}")).alias(seq_col),
            is_del.alias(deleted_col)]
    if stamped:
        at = F.when(newer, F.col(f"_last.{time_col}")).otherwise(F.col(f"_t.{deleted_at_col}"))
        out.append(F.when(is_del, at).cast(target.schema[deleted_at_col].dataType).alias(deleted_at_col))
    if remembers:
        held_by = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in writers]),
                                                 F.array(*[seq for seq, _ in writers.values()])),
                               lambda _, seq: seq.isNotNull())
        out.append(F.when(is_del, held_by).alias(columns_col))
    # live rows are only replaced by newer records; tombstones also by what fills them
    changed = newer | (F.col(f"_t.{deleted_col}") & fills)
    return j.where(changed).select(*out).select(*target.columns)


def cdc_merge_frame(target: DataFrame, changes: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """K7 as a whole new table."""
    return upsert_frame(target, cdc_merge_rows(target, changes, keys, **kw), keys)
