"""What a query needs of each of its scans, read from the optimized plan.

Every scan is a relation of its own with an option ``ref``. The optimizer puts the filters that apply to all
rows of a scan directly above it, and a projection above these that names the columns in use. Both become
options of a second plan of the same query: windows and tags that prune blocks and files, and the columns to
decode. The filters stay in the query, and nothing is kept beyond it, so a scan that is used again is not narrowed.
A scan that the plan has more than once gets no window and the columns of all its uses.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .ranges import LEAST, MOST, Window

REF = "ref"


@dataclass
class Hint:
    """Rows that a query can use: of these chromosomes (None: any) within [low, high], of these tags (None: any); and the columns it reads (None: all)."""

    chroms: list[str] | None = None
    low: int = LEAST
    high: int = MOST
    tags: list[str] | None = None
    columns: list[str] | None = field(default=None)

    def to_option(self) -> str:
        return json.dumps([self.chroms, self.low, self.high, self.tags, self.columns])

    @classmethod
    def of_option(cls, text: str | None) -> Hint:
        return cls(*json.loads(text)) if text else cls()

    def windows(self, hard: Window) -> list[Window]:
        """The windows to read, in the order of the file, within a window that the caller asked for; disjoint."""
        chroms = [None] if self.chroms is None else sorted(set(self.chroms), key=str.encode)
        met = [hard.meet(Window(c, self.low, self.high, self.low > self.high)) for c in chroms]
        return [w for w in met if not w.empty]

    def narrow(self, kind: str, name: str, value: object, key: tuple[str, str | None], source: str | None) -> None:
        """Take in one condition ``name kind value``; what can't prune is passed over."""
        chrom, pos = key
        whole = isinstance(value, int) and not isinstance(value, bool)
        if name in (chrom, source) and kind in ("EqualTo", "EqualNullSafe", "In"):
            asked = value if kind == "In" else [value]
            if all(isinstance(x, str) or x is None for x in asked):
                asked = [x for x in asked if x is not None]
                if name == chrom:
                    self.chroms = asked if self.chroms is None else [x for x in self.chroms if x in asked]
                else:
                    self.tags = asked if self.tags is None else [x for x in self.tags if x in asked]
        elif name == pos and whole:
            low, high = {"EqualTo": (value, value), "EqualNullSafe": (value, value), "GreaterThan": (value + 1, MOST), "GreaterThanOrEqual": (value, MOST), "LessThan": (LEAST, value - 1), "LessThanOrEqual": (LEAST, value)}.get(kind, (LEAST, MOST))
            self.low, self.high = max(self.low, low), min(self.high, high)
        elif name == pos and kind == "In" and value and all(isinstance(x, int) for x in value):
            self.low, self.high = max(self.low, min(value)), min(self.high, max(value))


def _each(seq) -> Iterator:
    for i in range(seq.size()):
        yield seq.apply(i)


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _conjuncts(condition) -> Iterator:
    if _kind(condition) == "And":
        yield from _conjuncts(condition.left())
        yield from _conjuncts(condition.right())
    else:
        yield condition


def _names(attributes) -> list[str]:
    return [a.name() for a in _each(attributes.toSeq())]


def _conditions(spark: SparkSession, condition) -> Iterator[tuple[str, str, object]]:
    """(kind, column, value) of the simple conditions among the conjuncts."""
    strategy = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.datasources, "DataSourceStrategy$"), "MODULE$")
    for part in _conjuncts(condition):
        found = strategy.translateFilter(part, False)
        if found.isDefined():
            f = found.get()
            kind = _kind(f)
            if kind == "In":
                yield kind, f.attribute().strip("`"), list(f.values())
            elif kind in ("EqualTo", "EqualNullSafe", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"):
                yield kind, f.attribute().strip("`"), f.value()


def _walk(spark: SparkSession, node, filters: list, needed: list[str] | None, out: list) -> None:
    """Gather (ref, schema, conditions, columns in use) of the scans below ``node``.

    ``filters`` are those between a scan and the projection above it; ``needed`` is what this projection and they use.
    """
    kind = _kind(node)
    if kind == "DataSourceV2ScanRelation":
        relation = node.relation()
        ref = relation.options().get(REF)
        if ref is not None:
            out.append((ref, [c for f in filters for c in _conditions(spark, f)], needed))
        return
    if kind == "Project":
        filters, needed = [], _names(node.references())
    elif kind == "Filter":
        filters = [*filters, node.condition()]
        needed = None if needed is None else needed + _names(node.references())
    else:
        filters, needed = [], None
    for child in _each(node.children()):
        _walk(spark, child, filters, needed, out)


def _is_command(spark: SparkSession, node) -> bool:
    command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    return command.isInstance(node) or any(_is_command(spark, x) for x in _each(node.children()))


@dataclass
class Columns:
    """Of a scan's table: all columns of the file in order, those of the relation, and whether the last of all is a dictionary's source."""

    all: list[str]
    own: list[str]
    dictionary: bool


def find(spark: SparkSession, query: str, scans: dict[str, Columns]) -> dict[str, Hint] | None:
    """The hints of each scan of a query by ref; None for a command, which may not be planned twice."""
    session = spark._jsparkSession.sessionState()
    skip = getattr(spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode, "SKIP")()
    execution = session.executePlan(session.sqlParser().parsePlan(query), skip)
    if _is_command(spark, execution.analyzed()):
        return None
    plan = execution.optimizedPlan()
    found: list = []
    for root in (plan, *_each(plan.subqueriesAll())):
        _walk(spark, root, [], None, found)
    out = {}
    for ref, names in scans.items():
        uses = [x for x in found if x[0] == ref]
        if not uses:
            continue
        hint = Hint()
        if len(uses) == 1:
            for condition in uses[0][1]:
                hint.narrow(*condition, (names.all[0], names.all[1] if len(names.all) > 1 else None), names.all[-1] if names.dictionary else None)
        if all(u[2] is not None for u in uses):
            asked = {n for u in uses for n in u[2]}
            hint.columns = [n for n in names.own if n in asked]
        out[ref] = hint
    return out
