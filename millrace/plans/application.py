"""The whole application wired from the environment: warehouse, clients, loads and models.

    MILLRACE_WAREHOUSE=hdfs:///games MILLRACE_CATALOG_CLIENT_ID=... MILLRACE_CATALOG_CLIENT_SECRET=... \\
        spark-submit -m millrace.plans.application '+game_stats'

MILLRACE_WAREHOUSE   root folder of the warehouse
MILLRACE_DUMPS       local folder for the catalog's dump files (the warehouse's folder by default, if that is local)
MILLRACE_CATALOG_CLIENT_ID, MILLRACE_CATALOG_CLIENT_SECRET   without them the dumps are taken as they lie in the folder
MILLRACE_<FIELD>     any value of EngineConfig
"""

from __future__ import annotations

import os
import sys
from dataclasses import dataclass

from pyspark.sql import SparkSession

from millrace.plans.ingest import ingest_nodes, open_warehouse
from millrace.plans.models import review_models
from millrace.plans.registry import BuildReport, Registry
from millrace.session import EngineConfig, configure
from millrace.sources.dumps import CatalogApi
from millrace.sources.tables import Warehouse


@dataclass
class Application:
    config: EngineConfig
    warehouse: Warehouse
    graph: Registry

    def run(self, select: str = "*") -> BuildReport:
        return self.graph.run(self.warehouse, select)


def from_environment(spark: SparkSession, environ: dict[str, str] | None = None, **source) -> Application:
    """Everything that a run needs; a missing setting is named at once. source: options of the review_pages source."""
    env = os.environ if environ is None else environ
    if not env.get("MILLRACE_WAREHOUSE"):
        raise KeyError("MILLRACE_WAREHOUSE is not set")
    root, config = env["MILLRACE_WAREHOUSE"], EngineConfig.from_env(env)
    client, secret = env.get("MILLRACE_CATALOG_CLIENT_ID"), env.get("MILLRACE_CATALOG_CLIENT_SECRET")
    if bool(client) != bool(secret):
        raise KeyError("MILLRACE_CATALOG_CLIENT_ID and MILLRACE_CATALOG_CLIENT_SECRET belong together")
    dumps = env.get("MILLRACE_DUMPS") or f"{root.removeprefix('file://')}/_dumps"
    warehouse = open_warehouse(configure(spark), root)
    api = CatalogApi(client, secret, config) if client else None
    graph = ingest_nodes(spark, config, dumps, api=api, **source).merge(review_models(config))
    return Application(config, warehouse, graph)


if __name__ == "__main__":
    session = SparkSession.builder.appName("millrace").getOrCreate()
    for n in sys.argv[1:] or ["*"]:
        report = from_environment(session).run(n)
        print(f"{n}: built {', '.join(report.built) or 'nothing'}; loaded {report.loaded}; skipped {', '.join(report.skipped) or 'nothing'}")
