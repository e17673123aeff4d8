"""References to records that do not exist.

Method: keys are integers (a UUID is one of 128 bits); the sorted keys of the targets are compressed into contiguous
runs; each reference key is matched as of the start of the preceding run and is an orphan when it lies beyond the end
of that run. Nothing else tells whether a target exists; the life time of the target at the end of the as-of match then tells whether it existed when the
reference was made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.keys import raw_or_canonical_uuid
from pagemill.plans.stages import salted_join, stored

def integer_key(table: Column, key: Column) -> Column:
    """(high, low): a key as an integer within its table, as 16 hex digits of the table and the upper half, and the lower half as a number.

    Canonical UUIDs are read as numbers; any other text is numbered by its hash.
    """
    h = F.when(key.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.replace(key, F.lit("-"), F.lit(""))).otherwise(F.md5(key))
    low = F.conv(F.substring(h, 17, 16), 16, 10).cast("decimal(20,0)")
    return F.struct(F.concat(table, F.lit("/"), F.substring(h, 1, 16)).alias("high"), low.alias("low"))


def key_runs(rows: DataFrame) -> DataFrame:
    """rows (block, key, is_parent, …) with (run, run_start): the number and start of the last run of parents at or before each row in its block, 0 and null before the first.

    A run is a stretch of parent keys without a gap; keys are distinct within each kind of row.
    """
    order = Window.partitionBy("block").orderBy("key.high", "key.low", F.desc("is_parent"))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col("is_parent"), F.col("key")), ignorenulls=True).over(upto)
    follows = (F.col("before.high") == F.col("key.high")) & (F.col("before.low") + 1 == F.col("key.low"))
    starts = F.col("is_parent") & ~F.coalesce(follows, F.lit(False))
    r = rows.withColumn("before", before).withColumn("start", starts)
    return r.withColumn("run", F.sum(F.col("start").cast("int")).over(order)).withColumn("run_start", F.last(F.when(F.col("start"), F.col("key")), ignorenulls=True).over(order)).drop("before", "start")


def beyond_runs(keys: DataFrame, life: tuple[str, ...] = ("arrived_at", "deleted_at")) -> DataFrame:
    """(key, is_orphan, …life) of the reference keys among keys (key, is_parent, …life): as-of match to the preceding run start, orphans lying beyond the run's end.

    Keys are distinct on each side, so no task can get a hot one; blocks are ranges of the sorted keys, so no task gets more than its share.
    life comes from the last parent at or before the reference, which for a key within a run is the key itself.
    """
    placed = keys.repartitionByRange("key.high", "key.low").withColumn("block", F.spark_partition_id())
    placed = stored(placed, "key-ranges")  # the ranges depend on sampled bounds, so they are drawn once
    w = Window.partitionBy("block").orderBy("key.high", "key.low", F.desc("is_parent"))
    r = key_runs(placed).withColumn("life", F.last(F.when(F.col("is_parent"), F.struct(*life)), ignorenulls=True).over(w))
    end = F.max(F.when(F.col("is_parent"), F.col("key"))).over(Window.partitionBy("block", "run"))
    r = r.withColumn("run_end", end).where("not is_parent")
    return r.select("key", (F.col("run_start").isNull() | (F.col("key") > F.col("run_end"))).alias("is_orphan"), "life.*")


def orphan_references(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """References that point to nothing that existed when they were made.

    refs: (ref_table, ref_field, ref_key, target_table, key, made_at); targets: (target_table,
    key, arrived_at, deleted_at). Returns (ref_table, ref_field, ref_key, made_at, reason) with reason
    ``missing``, ``late`` or ``deleted``.

    Defined cases: null, blank and all-zero keys refer to nothing and give no row; malformed
    keys are keys that no target has (``missing``); repeated rows of either side change
    nothing; a target with several rows lives from its earliest arrival to its latest deletion;
    a reference without made_at can only be ``missing``; empty inputs give empty or all-missing
    results; other columns are ignored.
    """
    t = targets.withColumn("_k", raw_or_canonical_uuid(F.col("key"))).where("_k is not null").select(integer_key(F.col("target_table"), F.col("_k")).alias("key"), "arrived_at", "deleted_at")
    t = t.groupBy("key").agg(F.min("arrived_at").alias("arrived_at"), F.max("deleted_at").alias("deleted_at"))
    r = refs.withColumn("_k", raw_or_canonical_uuid(F.col("key"))).where("_k is not null").select("ref_table", "ref_field", "ref_key", "made_at", integer_key(F.col("target_table"), F.col("_k")).alias("key"))
    r = stored(r, "references")
    none = F.lit(None).cast("timestamp")
    keys = t.select("key", F.lit(True).alias("is_parent"), "arrived_at", "deleted_at").unionByName(r.select("key").distinct().select("key", F.lit(False).alias("is_parent"), none.alias("arrived_at"), none.alias("deleted_at")))
    status = stored(beyond_runs(keys), "key-status")
    found = salted_join(r, status, "key", F.concat_ws("|", "ref_table", "ref_field", "ref_key"))
    reason = F.when(F.col("is_orphan"), "missing").when(F.col("arrived_at") > F.col("made_at"), "late").when(F.col("deleted_at") <= F.col("made_at"), "deleted")
    return found.select("ref_table", "ref_field", "ref_key", "made_at", reason.alias("reason")).where("reason is not null").distinct()


def document_references(records: DataFrame, chunk_sets: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The references and targets of the document tables, for orphan_references."""
    rec_id, set_id = raw_or_canonical_uuid(F.col("id")), raw_or_canonical_uuid(F.col("set_id"))
    ent = raw_or_canonical_uuid(F.col("entity_id"))
    r = records.select(rec_id.alias("ref_key"), ent.alias("key"), "arrived_at")
    made = r.groupBy("ref_key").agg(F.min("arrived_at").alias("made_at"), F.collect_set("key").alias("keys"))
    row = lambda df, table, field, target: df.select(F.lit(table).alias("ref_table"), F.lit(field).alias("ref_field"), "ref_key", F.lit(target).alias("target_table"), "key", "made_at")
    refs = row(made.select("ref_key", "made_at", F.explode("keys").alias("key")), "records", "entity_id", "entities")
    sets = chunk_sets.select(set_id.alias("ref_key"), F.col("produced_at").alias("made_at"), F.explode(F.array(F.struct(F.lit("document_id").alias("field"), F.lit("records").alias("target_table"), F.col("document_id").alias("key")), F.struct(F.lit("entity_id").alias("field"), F.lit("entities").alias("target_table"), F.col("entity_id").alias("key")))).alias("r"))
    refs = refs.unionByName(sets.select(F.lit("chunk_sets").alias("ref_table"), F.col("r.field").alias("ref_field"), "ref_key", F.col("r.target_table").alias("target_table"), F.col("r.key").alias("key"), "made_at"))
    targets = entities.select(F.lit("entities").alias("target_table"), F.col("entity_id").alias("key"), "arrived_at", "deleted_at").unionByName(records.select(F.lit("records").alias("target_table"), F.col("id").alias("key"), "arrived_at", "deleted_at"))
    return refs, targets


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field, month of the reference and reason; a missing time gives a null month."""
    return orphans.groupBy("ref_table", "ref_field", F.date_format(F.date_trunc("month", "made_at"), "yyyy-MM").alias("month"), "reason").agg(F.count(F.lit(1)).alias("n_orphans"))
