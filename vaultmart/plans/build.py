"""Bronze -> staging -> hashed staging -> vault, driven by the registry.

``build_vault`` is lazy: with ``targets`` given (the current vault
tables) it returns target + new rows per table, which is what an
incremental load appends.  ``load_vault`` persists the new rows to an
append-only Parquet folder per table.
"""

from __future__ import annotations

import os
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.hashing import FIRST, HOME, JOIN_HOME, as_bytes, home, stage
from vaultmart.operators import partitioned_vault as PV
from vaultmart.operators import vault as V
from vaultmart.plans import registry as R
from vaultmart.plans.staging import STAGING, stage_all
from vaultmart.session import materialize, materialize_all


def hashed_staging(staging: dict[str, DataFrame], names: list[str] | None = None, key_bytes: bool = False,
                   gather: bool = False) -> dict[str, DataFrame]:
    """The hashed stages; with ``key_bytes`` their keys and hashdiffs are the 16 bytes instead of the 32 characters.

    With ``gather`` the rows of the stages in ``R.GATHERED`` move once, as their business columns, to the home of their
    key and are hashed there; loaders and joins then find the rows of a key in one place (``HOME``)."""
    out = {}
    for hs in R.HASHED_STAGES:
        if hs.source not in staging or (names is not None and hs.name not in names):
            continue
        derived = {k: (v() if callable(v) else v) for k, v in hs.derived.items()}
        rows = staging[hs.source]
        if gather and hs.name in R.GATHERED:
            key, part = R.GATHERED[hs.name]
            if HOME not in rows.columns:
                # a row without the key is taken by no table; the home is not moved but computed again where the rows arrive
                rows = rows.where(F.trim(key) != "").repartition(home(key, part)).withColumn(HOME, home(key, part))
            if key == "txn_bk":
                rows = rows.withColumn(JOIN_HOME, home("claim_line_bk", FIRST))
        elif HOME in rows.columns and not gather:
            rows = rows.drop(HOME)
        out[hs.name] = stage(rows, hs.hashed, hs.hashdiff, derived)
        if key_bytes:
            out[hs.name] = as_bytes(out[hs.name], [*hs.hashed, *hs.hashdiff])
    return out


def gathered_once(rows: DataFrame, key: str, part: int) -> DataFrame:
    """``rows`` at the home of their key, moved once for all tables that one query loads from them.

    The readers take different columns.  Pruned before the move, these would make it another move for each reader; unpacked
    from an array after it, they are all columns for every reader, and Spark reuses the exchange.  Rows without the key,
    which some tables take for another key, are not gathered but spread."""
    return moved_once(rows, F.when(F.trim(key) != "", home(key, part)).otherwise(F.xxhash64(*rows.columns)))


def moved_once(rows: DataFrame, at: Column) -> DataFrame:
    """``rows`` gathered by ``at`` (their ``HOME``), with all columns for every reader."""
    return rows.repartition(at).select(at.alias(HOME), F.inline(F.array(F.struct(*rows.columns))))


def _gathered_bronze(bronze: dict[str, DataFrame], names: list[str] | None) -> dict[str, DataFrame]:
    """Bronze inputs of two or more tables that are gathered by the same key."""
    sources = [t.source for t in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS) if names is None or t.name in names]
    return {b: gathered_once(bronze[b], *R.GATHERED[stages[0]]) for b, stages in R.GATHERED_BRONZE.items()
            if b in bronze and sum(s in stages for s in sources) >= 2}


def new_vault_rows(hashed: dict[str, DataFrame], targets: dict[str, DataFrame] | None = None,
                   names: list[str] | None = None, columns: dict[str, Collection[str]] | None = None) -> dict[str, DataFrame]:
    """Rows each vault table would append for this batch; of a table named in ``columns`` only these and its key."""
    targets, columns = targets or {}, columns or {}
    out: dict[str, DataFrame] = {}
    for h in R.HUBS:
        if h.source in hashed and (names is None or h.name in names):
            out[h.name] = V.new_hub_rows(hashed[h.source], h.pk, h.bk, targets.get(h.name), columns.get(h.name))
    for lk in R.LINKS:
        if lk.source in hashed and (names is None or lk.name in names):
            out[lk.name] = V.new_link_rows(hashed[lk.source], lk.pk, list(lk.fks), targets.get(lk.name), columns.get(lk.name))
    for s in R.SATELLITES:
        if s.source in hashed and (names is None or s.name in names):
            out[s.name] = V.new_satellite_rows(hashed[s.source], s.pk, s.hashdiff, list(s.payload),
                                               targets.get(s.name), columns=columns.get(s.name))
    for t in R.TLINKS:
        if t.source in hashed and (names is None or t.name in names):
            out[t.name] = V.new_tlink_rows(hashed[t.source], t.pk, list(t.fks), list(t.payload), t.effective,
                                           targets.get(t.name), columns.get(t.name))
    return out


class _Recorder(dict):
    """Records which bronze tables a staging model reads (plans only, no job)."""

    def __init__(self, base):
        super().__init__(base)
        self.used: set[str] = set()

    def __getitem__(self, k):
        self.used.add(k)
        return super().__getitem__(k)


def _plan_inputs(bronze: dict[str, DataFrame], load_dts, names: list[str] | None):
    """Staging models, hashed stages and bronze consumer counts for the requested tables."""
    tables = [t for t in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS) if names is None or t.name in names]
    src_of = {hs.name: hs.source for hs in R.HASHED_STAGES}
    hashed_names = sorted({t.source for t in tables})
    staging_names = sorted({src_of[h] for h in hashed_names})
    bronze_uses: dict[str, int] = {}
    for stg in staging_names:
        rec = _Recorder(bronze)
        try:
            STAGING[stg](rec, load_dts)
        except KeyError:
            continue
        n_consumers = sum(1 for t in tables if src_of[t.source] == stg)
        for b in rec.used:
            bronze_uses[b] = bronze_uses.get(b, 0) + n_consumers
    return hashed_names, staging_names, bronze_uses


def build_vault(bronze: dict[str, DataFrame], load_dts=None, targets: dict[str, DataFrame] | None = None,
                names: list[str] | None = None, spark: SparkSession | None = None, key_bytes: bool = False,
                reread: Collection[str] = (), columns: dict[str, Collection[str]] | None = None,
                gather: bool = False, one_job: bool = False) -> dict[str, DataFrame]:
    """Vault after this batch: target + new rows for every table (lazy).  ``key_bytes``, ``gather`` (of a first batch; the
    tables then carry ``HOME``): see ``hashed_staging``.  With ``gather`` and ``one_job`` (the tables are read in one job) inputs
    of several gathered tables are neither written nor moved for each of them: see ``gathered_once``.

    With ``spark`` given, every bronze input feeding two or more of the
    requested tables is written once (Parquet, shared checkpoint folder)
    and read back, so its source joins run once per batch instead of once
    per loader, and the plans of the loaders stay shallow.  Not written are
    the inputs named in ``reread``: a projection of one stored table costs
    less to read again.  ``columns``: see ``new_vault_rows`` (without targets).
    """
    hashed_names, staging_names, uses = _plan_inputs(bronze, load_dts, names)
    moved = _gathered_bronze(bronze, names) if gather and one_job else {}
    if spark is not None:
        bronze = {k: v for k, v in bronze.items() if k in uses}
        at_home = [k for k, v in bronze.items() if gather and one_job and HOME in v.columns]         # they come moved, once for all readers
        bronze |= materialize_all(spark, {k: v for k, v in bronze.items() if uses[k] >= 2 and not (k in reread or k in moved or k in at_home)})
    staging = stage_all({**bronze, **moved}, load_dts, staging_names)
    hashed = hashed_staging(staging, hashed_names, key_bytes, gather)
    new = new_vault_rows(hashed, targets, names, columns)
    targets = targets or {}
    return {k: (targets[k].unionByName(v) if k in targets else v) for k, v in new.items()}


def load_vault(spark: SparkSession, root: str, bronze: dict[str, DataFrame], load_dts=None,
               names: list[str] | None = None) -> dict[str, DataFrame]:
    """Append this batch's new rows under ``root/<table>``; return the tables.

    Bronze inputs read by several loaders are written once per batch
    (lineage cut in the shared checkpoint folder) so the loaders do not
    recompute the landing joins.
    """
    hashed_names, staging_names, uses = _plan_inputs(bronze, load_dts, names)
    bronze = {k: (materialize(spark, v, k) if uses.get(k, 0) >= 2 else v) for k, v in bronze.items() if k in uses}
    staging = stage_all(bronze, load_dts, staging_names)
    hashed = hashed_staging(staging, hashed_names)
    targets = {}
    wanted = set(names) if names else None
    for name in [x.name for x in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS)]:
        if wanted is not None and name not in wanted:
            continue
        t = V.read_table(spark, os.path.join(root, name))
        if t is not None:
            targets[name] = t
    new = new_vault_rows(hashed, targets, names)
    for name, rows in new.items():
        V.append(rows, os.path.join(root, name))
    return {name: spark.read.parquet(os.path.join(root, name)) for name in new}


def partitioned_table(spark: SparkSession, root: str, name: str, prefix_chars: int = 2) -> PV.PartitionedTable:
    """The registry's table ``name`` as a partitioned table under ``root``."""
    t, path = R.BY_NAME[name], os.path.join(root, name)
    if isinstance(t, R.Hub):
        return PV.hub_table(spark, path, t.pk, t.bk, prefix_chars)
    if isinstance(t, R.Link):
        return PV.link_table(spark, path, t.pk, list(t.fks), prefix_chars)
    if isinstance(t, R.Satellite):
        return PV.SatelliteTable(spark, path, t.pk, t.hashdiff, list(t.payload), prefix_chars)
    return PV.tlink_table(spark, path, t.pk, list(t.fks), list(t.payload), t.effective, prefix_chars)


def load_partitioned(spark: SparkSession, root: str, bronze: dict[str, DataFrame], names: list[str], load_dts=None,
                     batch_id: int | None = None, prefix_chars: int = 2, key_bytes: bool = False) -> dict[str, PV.PartitionedTable]:
    """``load_vault`` into partitioned tables: a load reads only the partitions that the batch's keys fall into.
    ``key_bytes`` is a choice for the table's whole life: its files hold the keys in that form."""
    hashed_names, staging_names, uses = _plan_inputs(bronze, load_dts, names)
    bronze = {k: (materialize(spark, v, k) if uses.get(k, 0) >= 2 else v) for k, v in bronze.items() if k in uses}
    hashed = hashed_staging(stage_all(bronze, load_dts, staging_names), hashed_names, key_bytes)
    tables = {name: partitioned_table(spark, root, name, prefix_chars) for name in names}
    for name, table in tables.items():
        table.load(hashed[R.BY_NAME[name].source], batch_id)
    return tables
