"""Queries of the training-data problem that belongs to the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.operators.orphans import document_references, orphan_references, orphans_by_period
from pagemill.sources.tables import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphan_references(*document_references(table(spark, d, "records"), table(spark, d, "chunk_sets"), table(spark, d, "entities")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_table", "ref_field", "ref_key", "reason").distinct()


def p5_orphans_by_month(spark: SparkSession, d: str) -> DataFrame:
    return orphans_by_period(_orphans(spark, d))


QUERIES = {"p5_found": p5_found, "p5_orphans_by_month": p5_orphans_by_month}

_KEY = "nullif(regexp_replace(regexp_replace(lower({0}), '^\\s*urn:uuid:', ''), '[^0-9a-f]', '', 'g'), '')"


def _uuid(c: str) -> str:
    k = _KEY.format(c)
    return f"(case when {k} is null or {k} = repeat('0', 32) then null else substr({k},1,8)||'-'||substr({k},9,4)||'-'||substr({k},13,4)||'-'||substr({k},17,4)||'-'||substr({k},21) end)"


_FOUND = f"""
with ent as (select {_uuid('entity_id')} k, min(arrived_at) a, max(deleted_at) d from entities group by 1),
rec as (select {_uuid('id')} k, min(arrived_at) a, max(deleted_at) d from records group by 1),
refs as (
  select distinct 'records' ref_table, 'entity_id' ref_field, r.rk ref_key, r.k, rec.a made, 'e' t
  from (select {_uuid('id')} rk, {_uuid('entity_id')} k from records) r join rec on rec.k = r.rk
  union select 'chunk_sets', 'document_id', {_uuid('set_id')}, {_uuid('document_id')}, produced_at, 'r' from chunk_sets
  union select 'chunk_sets', 'entity_id', {_uuid('set_id')}, {_uuid('entity_id')}, produced_at, 'e' from chunk_sets),
targets as (select 'e' t, * from ent union all select 'r', * from rec),
found as (
  select ref_table, ref_field, ref_key, made, case when targets.k is null then 'missing' when a > made then 'late' when d <= made then 'deleted' end reason
  from refs left join targets on refs.t = targets.t and refs.k = targets.k where refs.k is not null)
"""
ORACLES = {
    "p5_found": _FOUND + "select distinct ref_table, ref_field, ref_key, reason from found where reason is not null",
    "p5_orphans_by_month": _FOUND + "select ref_table, ref_field, strftime(made, '%Y-%m') as \"month\", reason, count(*) n_orphans from (select distinct * from found where reason is not null) group by all",
}
