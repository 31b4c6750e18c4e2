"""Declarative data tests and total-versus-parts reconciliation."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyspan.functions.measures import parts_diff, within
from tallyspan.operators.enrich import union_sources
from tallyspan.operators.reshape import pivot_max, stack_structs

REPORT_COLUMNS = ["table_name", "column_name", "test", "n_rows", "n_failed", "passed"]


@dataclass(frozen=True)
class Rule:
    """One declared test on one column.

    ``test`` is ``not_null``, ``unique``, ``accepted_values`` (with ``values``)
    or ``relationships`` (with ``parent`` and ``parent_column``).
    """

    table: str
    column: str
    test: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""


@dataclass(frozen=True)
class Slice:
    """A table that is a row slice of a larger frame, by SQL condition.

    Slices of the same frame are tested in the same pass over it.
    """

    frame: DataFrame
    where: str


def contract(tables: Sequence[str], tests: Mapping[str, Sequence[str]]) -> list[Rule]:
    """One column contract applied to many tables."""
    return [Rule(t, c, test) for t in tables for c, names in tests.items() for test in names]


def sql_literal(value: object) -> str:
    """A value as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def _report_rows(rows: Sequence[tuple[Rule, str, str]]) -> str:
    """Expression for one report row per rule, from its row and failure counts."""
    structs = [
        f"named_struct('table_name', {sql_literal(r.table)}, 'column_name', {sql_literal(r.column)}, "
        f"'test', '{r.test}', 'n_rows', {n}, 'n_failed', {failed}, 'passed', {failed} = 0)"
        for r, n, failed in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def _failure(rule: Rule) -> str:
    if rule.test == "not_null":
        return f"`{rule.column}` is null"
    accepted = ", ".join(sql_literal(v) for v in rule.values)
    return f"`{rule.column}` is not null and `{rule.column}` not in ({accepted})"


def _row_tests(frame: DataFrame, rules: Sequence[tuple[Rule, str]]) -> DataFrame:
    """All NULL and value-list tests of a frame in one aggregate."""
    aggs, rows, tested = [], [], {}
    for where in dict.fromkeys(where for _, where in rules):
        tested[where] = f"_n{len(tested)}"
        aggs.append(F.expr(f"count_if({where}) as {tested[where]}"))
    for i, (rule, where) in enumerate(rules):
        aggs.append(F.expr(f"count_if(({where}) and ({_failure(rule)})) as _f{i}"))
        rows.append((rule, tested[where], f"_f{i}"))
    return frame.agg(*aggs).selectExpr(_report_rows(rows))


ROW_TESTS = ("not_null", "accepted_values")
REPORT = "table_name string, column_name string, test string, n_rows bigint, n_failed bigint, passed boolean"


def metrics_of(seen: Observation, frame: DataFrame) -> Mapping[str, int]:
    """What was counted while the frame was written; zeros where the planner saw that it has no rows and observed nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        if not frame.isEmpty():
            raise
        return defaultdict(int)


@dataclass
class Observed:
    """Row tests of a frame that are counted while it is written.

    rules: each with the SQL condition of the rows that it is about. Use
    ``frame`` in the write, ``report`` afterwards. The counts are exact where the
    observed rows are those that the write's tasks put out; a task that is run
    again counts once.
    """

    frame: DataFrame
    rules: list[tuple[Rule, str]]
    seen: Observation = field(default_factory=Observation)

    def __post_init__(self) -> None:
        self.plain = self.frame
        self.wheres = list(dict.fromkeys(where for _, where in self.rules))
        counts = [F.expr(f"count_if({where})").alias(f"n{i}") for i, where in enumerate(self.wheres)]
        counts += [F.expr(f"count_if(({where}) and ({_failure(rule)}))").alias(f"f{i}") for i, (rule, where) in enumerate(self.rules)]
        if self.rules:
            self.frame = self.frame.observe(self.seen, *counts)

    def report(self) -> list[tuple]:
        """Report rows, after the frame was written."""
        if not self.rules:
            return []
        found = metrics_of(self.seen, self.plain)
        out = []
        for i, (rule, where) in enumerate(self.rules):
            n, failed = found[f"n{self.wheres.index(where)}"], found[f"f{i}"]
            out.append((rule.table, rule.column, rule.test, n, failed, failed == 0))
        return out


def row_rules(rules: Sequence[Rule], tables: Mapping[str, str]) -> list[tuple[Rule, str]]:
    """The row tests of the tables that a frame holds, by table name with the condition that slices it out of the frame."""
    return [(rule, tables[rule.table]) for rule in rules if rule.test in ROW_TESTS and rule.table in tables]


def _unique_test(frame: DataFrame, rule: Rule) -> DataFrame:
    """Failures are the keys that occur more than once; NULL keys are ignored."""
    per_key = frame.groupBy(F.col(rule.column).alias("_k")).agg(F.expr("count(1) as _c"))
    found = per_key.agg(
        F.expr("coalesce(sum(_c), 0L) as _n"),
        F.expr("count_if(_k is not null and _c > 1) as _f"),
    )
    return found.selectExpr(_report_rows([(rule, "_n", "_f")]))


def _relationship_test(frame: DataFrame, parent: DataFrame, rule: Rule) -> DataFrame:
    """Failures are child rows whose non-NULL key has no parent.

    The child is counted per key before the join, so a key that fills a third
    of the child reaches the join as one row.
    """
    child = frame.groupBy(F.col(rule.column).alias("_k")).agg(F.expr("count(1) as _c"))
    known = parent.select(F.col(rule.parent_column).alias("_k")).where("_k is not null").distinct()
    found = child.join(known.withColumn("_known", F.lit(True)), "_k", "left").agg(
        F.expr("coalesce(sum(_c), 0L) as _n"),
        F.expr("coalesce(sum(if(_known is null and _k is not null, _c, 0L)), 0L) as _f"),
    )
    return found.selectExpr(_report_rows([(rule, "_n", "_f")]))


def run_rules(tables: Mapping[str, DataFrame | Slice], rules: Sequence[Rule]) -> DataFrame:
    """Report of every rule: ``table, column, test, rows, failures, passed``.

    All row tests on one frame share one pass; a uniqueness or relationship
    test adds one exchange of its key counts.
    """

    def frame_of(name: str) -> DataFrame:
        t = tables[name]
        return t.frame.where(t.where) if isinstance(t, Slice) else t

    by_frame: dict[int, tuple[DataFrame, list[tuple[Rule, str]]]] = {}
    reports: list[DataFrame] = []
    for rule in rules:
        table = tables[rule.table]
        if rule.test in ROW_TESTS:
            frame, where = (table.frame, table.where) if isinstance(table, Slice) else (table, "true")
            by_frame.setdefault(id(frame), (frame, []))[1].append((rule, where))
        elif rule.test == "unique":
            reports.append(_unique_test(frame_of(rule.table), rule))
        elif rule.test == "relationships":
            reports.append(_relationship_test(frame_of(rule.table), frame_of(rule.parent), rule))
        else:
            raise ValueError(f"unknown test {rule.test!r}")
    reports = [_row_tests(frame, pairs) for frame, pairs in by_frame.values()] + reports
    return union_sources(reports).select(*REPORT_COLUMNS)


def failing_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    """Values outside the accepted list, with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; NULL keys excluded."""
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return counted.join(known, key, "left_anti")


@dataclass(frozen=True)
class Check:
    """``total`` should equal the sum of ``parts`` within each key.

    ``only`` keeps the rows the comparison is about, by attribute value.
    """

    name: str
    total: str
    parts: tuple[str, str]
    only: Mapping[str, str] = field(default_factory=dict)

    @property
    def metrics(self) -> list[str]:
        return [self.total, *self.parts]

    def applies(self, metric: str) -> Column:
        cond = F.col(metric).isin(*self.metrics)
        for name, wanted in self.only.items():
            cond = cond & (F.col(name) == F.lit(wanted))
        return cond


def check_table(df: DataFrame, check: Check, keys: Sequence[str], metric: str = "metric_key") -> DataFrame:
    """One check with its measures under their own names, plus ``diff``."""
    wide = pivot_max(df.where(check.applies(metric)), keys, {m: m for m in check.metrics}, metric)
    return wide.select(
        F.lit(check.name).alias("check_name"),
        *keys,
        *check.metrics,
        parts_diff(check.total, check.parts).alias("diff"),
    )


def reconcile(
    df: DataFrame,
    checks: Sequence[Check],
    keys: Sequence[str],
    metric: str = "metric_key",
    tolerance: float = 1e-6,
) -> DataFrame:
    """Every check in one pass: a single aggregate per key, then one row per check.

    A check reports a key only where at least one of its metrics has a row.
    """
    wanted, measures, seen = F.lit(False), {}, []
    for i, check in enumerate(checks):
        applies = check.applies(metric)
        wanted = wanted | applies
        seen.append(F.max(applies.cast("int")).alias(f"_seen{i}"))
        for j, m in enumerate(check.metrics):
            measures[f"_m{i}_{j}"] = applies & (F.col(metric) == F.lit(m))
    wide = pivot_max(df.where(wanted), keys, measures, metric, extra=seen)
    rows = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.col(f"_m{i}_0").alias("total"),
            F.col(f"_m{i}_1").alias("part1"),
            F.col(f"_m{i}_2").alias("part2"),
            F.col(f"_seen{i}").alias("_seen"),
        )
        for i, check in enumerate(checks)
    ]
    report = stack_structs(wide, keys, rows).where(F.col("_seen") == 1)
    diff = parts_diff("total", ["part1", "part2"])
    return report.select(
        "check_name", *keys, "total", "part1", "part2", diff.alias("diff"), within(diff, tolerance).alias("reading")
    )
