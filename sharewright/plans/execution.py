"""The run that writes: load log, conformed tables, shares, rule log and trails, in one commit, stopped by gates."""
from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..model import Catalogue
from ..operators.share import blocked_by
from ..session import Stages
from ..settings import Settings
from ..sources.ingest import reconcile, require_reconciled
from ..sources.sinks import PublicationBlocked
from ..sources.versions import VersionStore
from .calendars import TARGET as CALENDAR
from .coverages import TARGET as COVERAGE
from .pipeline import Run, run_pipeline
from .products import TARGET as PRODUCTS
from .sales import TARGET as SALES
from .stores import TARGET as STORES
from .territories import TARGET as HISTORY

# every flow may remove or correct rows, so a run owns the trails of all of them, also of those it left clean
TARGETS = (PRODUCTS, STORES, HISTORY, CALENDAR, SALES, COVERAGE)
#: Tables a blocked run must not change; log and trails are written all the same.
PUBLISHED = ("silver.dim_produto", "silver.dim_loja", "silver.territorio_historico", "silver.dim_calendario",
             "silver.fato_vendas", "silver.cobertura_fornecedor", "gold.cobertura_semana_rede", "gold.fato_vendas",
             "gold.market_share")
LOADS, LOG, QUARANTINE, CORRECTIONS = "dq.bronze_load_log", "dq.rule_results", "dq.quarantine", "dq.corrections"


def publish_run(store: VersionStore, run: Run, run_id: str,
                gates: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None) -> int:
    """Write a finished run and commit it once. Returns the version.

    The gates of the run, or `gates(tables as written)`, decide on the published tables only: if a critical one fails,
    log, quarantine and corrections are committed, the published tables stay as they were, and PublicationBlocked is raised.
    """
    change = store.begin(run_id)
    change.append(LOG, run.log)
    change.replace_targets(QUARANTINE, run.quarantine, TARGETS)
    change.replace_targets(CORRECTIONS, run.corrections, TARGETS)
    frames = (run.products.rows, run.stores.rows, run.history.rows, run.calendar.rows, run.sales.rows, run.coverage.rows,
              run.chain_coverage, run.published, run.shares)
    written = {name: change.overwrite(name, df) for name, df in zip(PUBLISHED, frames)}
    failed = blocked_by(gates(written) if gates else run.gates)
    if failed:
        version = change.without(*PUBLISHED).commit()
        raise PublicationBlocked(f"blocked by {failed}; version {version} holds the log and the trails only")
    return change.commit()


def execute(spark: SparkSession, raw: Mapping[str, DataFrame], declared: DataFrame, root: str,
            settings: Settings = Settings(), catalogue: Catalogue | None = None, run_id: str = "run",
            gates: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None) -> int:
    """From raw text tables to a committed version of the store at `root`. Returns the version.

    declared: table_name, source_file, expected_rows. The load log is committed first, so that it stays when the counts differ
    and the run stops (ReconciliationError). Intermediates are removed when the run ends, however it ends.
    """
    store = VersionStore(spark, root)
    loads = store.begin(run_id)
    loads.append(LOADS, reconcile(raw, declared, run_id), "loaded_at")
    loads.commit()
    last = store.read(LOADS).where(f"load_id = '{run_id}'")
    require_reconciled(last)
    stages = Stages(spark, "run")
    try:
        return publish_run(store, run_pipeline(spark, raw, stages, settings, catalogue, run_id), run_id, gates)
    finally:
        stages.close()
