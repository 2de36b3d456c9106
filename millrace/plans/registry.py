"""Model graph: nodes with layers, dependencies and checks, built in order."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from string import Formatter

from pyspark.sql import DataFrame

from millrace.operators.quality import Check, CheckResult, run_check, run_not_nulls
from millrace.sources.tables import Layout, commented


@dataclass(frozen=True)
class Node:
    """A model, a load or a source (neither).

    build receives {dependency: DataFrame}; load gets the warehouse, writes what it loads
    and returns its metrics. doc and columns become comments of the table and its columns
    in the catalog; columns that carry a comment from a dependency keep it.
    """

    name: str
    layer: str
    build: Callable[[dict[str, DataFrame]], DataFrame] | None = None
    deps: tuple[str, ...] = ()
    checks: tuple[Check, ...] = ()
    produced_by: str | None = None
    load: Callable[[object], object] | None = None
    doc: str = ""
    columns: dict[str, str] = field(default_factory=dict)
    layout: Layout | None = None

    @property
    def table(self) -> str:
        return f"{self.layer}.{self.name}"


def sql_node(name: str, layer: str, sql: str, args: dict | None = None, **more) -> Node:
    """A model from SQL text. {other} stands for another model, which becomes a dependency; :name for a value in args."""
    deps = tuple(dict.fromkeys(field for _, field, _, _ in Formatter().parse(sql) if field))
    if not deps:
        raise ValueError(f"{name} reads no model")

    def build(frames: dict[str, DataFrame]) -> DataFrame:
        return frames[deps[0]].sparkSession.sql(sql, args=args or {}, **{d: frames[d] for d in deps})

    return Node(name, layer, build, deps, **more)


def database_for(folder: str, custom: str | None = None) -> str:
    """Database of a model: a given name wins, else the folder path with underscores."""
    return custom.strip() if custom else folder.strip("/").replace("/", "_")


@dataclass
class BuildReport:
    built: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    checks: list[CheckResult] = field(default_factory=list)
    loaded: dict[str, object] = field(default_factory=dict)


class Registry:
    def __init__(self, nodes: list[Node] = ()):
        self.nodes: dict[str, Node] = {}
        for n in nodes:
            self.add(n)

    def add(self, node: Node) -> None:
        if node.name in self.nodes:
            raise ValueError(f"{node.name} is defined twice")
        self.nodes[node.name] = node

    def merge(self, other: Registry) -> Registry:
        return Registry([*self.nodes.values(), *other.nodes.values()])

    def needs(self, node: Node) -> set[str]:
        """Dependencies, with the load that produces a source."""
        return {*node.deps, *([node.produced_by] if node.produced_by in self.nodes else [])}

    def order(self) -> list[Node]:
        graph = TopologicalSorter({n.name: self.needs(n) for n in self.nodes.values()})
        return [self.nodes[x] for x in graph.static_order()]

    def select(self, what: str = "*") -> set[str]:
        """'*', 'layer:<name>', '<model>', '+<model>' (with ancestors) or '<model>+' (with descendants)."""
        if what == "*":
            return set(self.nodes)
        if what.startswith("layer:"):
            return {n.name for n in self.nodes.values() if n.layer == what[6:]}
        name = what.strip("+")
        if name not in self.nodes:
            raise KeyError(f"no model {name}")
        chosen = {name}
        if what.startswith("+"):
            for n in reversed(self.order()):
                chosen.update(self.needs(n) if n.name in chosen else ())
        if what.endswith("+"):
            for n in self.order():
                if chosen.intersection(self.needs(n)):
                    chosen.add(n.name)
        return chosen

    def frames(self, sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Every model as one lazy plan over the given sources; nothing is written."""
        out = dict(sources)
        for n in self.order():
            if n.name not in out and n.build:
                out[n.name] = n.build({d: out[d] for d in n.deps})
        return out

    def run(self, warehouse, select: str = "*", full_refresh: bool = False, threads: int = 4) -> BuildReport:
        """Run the selected loads, build the selected models as tables and run their checks.

        Nodes that wait for nothing run side by side, up to threads at a time, while
        Spark shares the executors among them. A check that ends in error skips all
        descendants. Models are rebuilt whole either way, so full_refresh changes no result.
        """
        chosen, report, blocked = self.select(select), BuildReport(), set()
        graph = TopologicalSorter({n.name: self.needs(n) for n in self.nodes.values()})
        graph.prepare()
        with ThreadPoolExecutor(threads) as pool:
            running: dict[Future, Node] = {}
            while graph.is_active():
                for name in sorted(graph.get_ready()):
                    n = self.nodes[name]
                    if blocked.intersection(self.needs(n)):
                        blocked.add(name)
                        if name in chosen and (n.build or n.load):
                            report.skipped.append(name)
                    elif name in chosen:
                        running[pool.submit(self._run_node, n, warehouse)] = n
                        continue
                    graph.done(name)
                if not running:
                    continue
                finished, _ = wait(running, return_when=FIRST_COMPLETED)
                for f in finished:
                    n = running.pop(f)
                    metrics, found = f.result()
                    if n.load:
                        report.loaded[n.name] = metrics
                    if n.build:
                        report.built.append(n.name)
                    report.checks += found
                    if any(r.status == "error" for r in found):
                        blocked.add(n.name)
                    graph.done(n.name)
        return report

    def _run_node(self, n: Node, warehouse) -> tuple[object, list[CheckResult]]:
        metrics = n.load(warehouse) if n.load else None
        if n.build:
            built = n.build({d: warehouse.read(self.nodes[d].table) for d in n.deps})
            warehouse.publish(n.table, commented(built, n.columns), comment=n.doc or None, layout=n.layout)
        if not n.checks:
            return metrics, []
        df = warehouse.read(n.table)
        nulls = [c for c in n.checks if c.kind == "not_null"]
        return metrics, run_not_nulls(nulls, df) + [run_check(c, df) for c in n.checks if c not in nulls]
