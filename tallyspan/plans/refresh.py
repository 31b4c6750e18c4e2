"""Stored models that are rebuilt where their inputs changed.

A state beside the models keeps a digest of every input at the last build: the
files of each dataset, the seeds, the parameters. A refresh compares, rebuilds
the datasets whose files changed, then the models that depend on a change,
along declared edges. The state is written last, so a refresh that broke off is
done again. Each model is replaced whole and each dataset's partition at the
commit of its job, so readers find the earlier rows until the new ones are
complete.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.operators import dimension
from tallyspan.operators.quality import REPORT, metrics_of
from tallyspan.plans import checks, ingest
from tallyspan.plans import warehouse as wh
from tallyspan.session import new_shared_path
from tallyspan.sources import audit, replace, seeds

ATOMIC, STATE, TESTS, NAMES = "int_demography_atomic", "_state", "_tests", "_geo_names"
#: What each stored model is built from: other models, seeds, and the metrics of the atomic table (None: all).
EDGES: dict[str, tuple[tuple[str, ...], frozenset[str] | None]] = {
    "dim_geo": (("geo_override",), None),
    "mart_region_overview_yearly": (("dim_geo", "prefix"), frozenset(fv.OVERVIEW_MEASURES)),
    "mart_population_split_yearly": (("prefix",), frozenset(fv.POPULATION_MEASURES)),
    "mart_births_by_sex_yearly": (("prefix",), frozenset(fv.BIRTH_MEASURES.values())),
    "mart_metric_coverage": (("prefix",), None),
}


def levels(models: Collection[str] = tuple(EDGES)) -> list[list[str]]:
    """The models in an order in which each level needs earlier ones only; those of one level can be written side by side."""
    out, left = [], dict.fromkeys(models)
    while left:
        ready = [m for m in left if not any(i in left for i in EDGES[m][0])]
        if not ready:
            raise ValueError(f"models that need each other: {sorted(left)}")
        out.append(ready)
        for m in ready:
            del left[m]
    return out


def affected(changed: Collection[str], metrics: Collection[str]) -> list[str]:
    """The models to rebuild when these inputs or the rows of these metrics changed, in the order of :func:`levels`."""
    known, found = set(changed), []
    for model in [m for level in levels() for m in level]:
        inputs, of_metrics = EDGES[model]
        touched = bool(metrics) if of_metrics is None else bool(of_metrics & set(metrics))
        if touched or known & set(inputs):
            known.add(model)
            found.append(model)
    return found


@dataclass
class State:
    """Digests at the last build: datasets by id (with their metrics), other inputs by name."""

    datasets: dict[str, str]
    metrics: dict[str, list[str]]
    inputs: dict[str, str]

    def write(self, spark: SparkSession, root: str) -> None:
        text = json.dumps([self.datasets, self.metrics, self.inputs], sort_keys=True)
        rows = spark.createDataFrame([(text,)], "value string").coalesce(1)
        replace.replaced(spark, f"{root}/{STATE}", lambda path: rows.write.text(path))


def read_state(spark: SparkSession, root: str) -> State:
    """The state of the last complete build; an empty one before the first."""
    if not replace.exists(spark, f"{root}/{STATE}"):
        return State({}, {}, {})
    return State(*json.loads(spark.read.text(f"{root}/{STATE}").first()[0]))


def _seed_digest(df: DataFrame) -> str:
    return df.agg(F.concat_ws("-", F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))).first()[0]


def refresh(
    spark: SparkSession, sources: Mapping[int, str], root: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX,
    years: Sequence[str] = wh.YEARS, first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    dictionary: DataFrame | None = None, overrides: DataFrame | None = None, skip: Collection[int] = fv.UNSTAGED_DATASETS,
) -> list[str]:
    """Bring the stored models up to date; the names of what was written, datasets as ``dataset=<id>``.

    The first refresh builds everything. Files are read once for their digests,
    headers and way of reading; then only changed datasets are scanned, and a
    dataset that is no longer among the sources goes. What a changed dataset's
    scan leaves out is listed under ``rejects``, by dataset.
    """
    root = root.rstrip("/")
    dictionary = seeds.dim_metric(spark) if dictionary is None else dictionary
    overrides = seeds.geo_override(spark) if overrides is None else overrides
    taken = {i: path for i, path in sources.items() if i not in skip}
    before = read_state(spark, root)
    records_path = new_shared_path(spark, "refresh-audit")
    audit.profile_files(spark, list(taken.values())).write.parquet(records_path)
    records = spark.read.parquet(records_path)
    now = {str(r.source): r.digest for r in audit.source_digests(records).collect() if r.source in taken}  # one row per dataset
    inputs = {
        "geo_override": _seed_digest(overrides),
        "prefix": str(prefix),
        "atomic": json.dumps([_seed_digest(dictionary), list(years), sorted(first_years.items())]),
    }
    metrics = {}
    for r in dictionary.select("dataset_id", "metric_key").where("dataset_id is not null and metric_key is not null").distinct().collect():
        metrics.setdefault(str(r.dataset_id), []).append(r.metric_key)
    everything = inputs["atomic"] != before.inputs.get("atomic") or not all(replace.exists(spark, f"{root}/{name}") for name in (ATOMIC, NAMES))
    changed = sorted(i for i in now if everything or now[i] != before.datasets.get(i))
    retired = sorted(set(before.datasets) - set(now))
    done, tests = [f"dataset={i}" for i in changed], read_tests(spark, root)
    build = {"years": years, "first_years": first_years, "skip": skip}
    if everything:
        staging = ingest.scan_audited(spark, records, sources=taken, **build)
        tests |= {row[:3]: row for row in ingest.store_atomic(spark, staging, dictionary, f"{root}/{ATOMIC}")}
        left = ingest.rejected_audited(spark, records, sources=taken, **build)
        replace.replaced(spark, f"{root}/rejects", lambda path: left.write.partitionBy("dataset_id").parquet(path))
        replace.replaced(spark, f"{root}/{NAMES}", lambda path: _write_names(wh.read_atomic(spark, f"{root}/{ATOMIC}"), path))
    elif changed or retired:
        places = {i: {*before.metrics.get(i, []), *metrics.get(i, [])} for i in [*changed, *retired]}
        found = _rebuild(spark, records, taken, root, changed, retired, places, dictionary, build)
        whole = {ATOMIC, *checks.FACTS, *[f"stg_sdmx_{i}_long" for i in retired]}  # counted anew where they are asked for
        tests = {k: row for k, row in tests.items() if k[0] not in whole} | found
    touched = {m for i in [*changed, *retired] for m in [*metrics.get(i, []), *before.metrics.get(i, [])]}
    names = affected([name for name, digest in inputs.items() if digest != before.inputs.get(name)], touched)
    atomic = wh.read_atomic(spark, f"{root}/{ATOMIC}")
    base = dimension.representatives(spark.read.schema(NAMES_SCHEMA).parquet(f"{root}/{NAMES}"), "geo_code", "geo_name_raw")
    tests |= write_models(spark, root, names, atomic, prefix, overrides, base)
    done += names
    if done:
        write_tests(spark, root, tests)
    State(now, {i: metrics.get(i, []) for i in now}, inputs).write(spark, root)
    return done


def write_models(
    spark: SparkSession, root: str, names: Collection[str], atomic: DataFrame, prefix: str | None, overrides: DataFrame, base: DataFrame | None = None
) -> dict[tuple, tuple]:
    """Write models level by level, those of a level side by side; returns their row tests.

    ``base`` is one raw name per geography, where it is known without the facts.
    """
    derived = wh.dim_geo(atomic, overrides) if base is None else wh.dim_geo_of(base, overrides)
    tests: dict[tuple, tuple] = {}
    for level in levels(names):
        geo = derived if "dim_geo" in level else spark.read.parquet(f"{root}/dim_geo")
        models = wh.build_models(spark, atomic, prefix, geo)
        for rows in side_by_side([lambda n=name, df=models[name]: _write_model(spark, n, df, root) for name in level]):
            tests |= rows
    return tests


def side_by_side(jobs: Sequence[Callable[[], dict]]) -> list[dict]:
    """Results of independent jobs, submitted together; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _write_model(spark: SparkSession, name: str, model: DataFrame, root: str) -> dict[tuple, tuple]:
    seen = checks.observed_model(name, model)
    replace.replaced(spark, f"{root}/{name}", lambda path: seen.frame.write.parquet(path))
    return {row[:3]: row for row in seen.report()}


def _rebuild(
    spark: SparkSession, records: DataFrame, sources: Mapping[int, str], root: str, changed: Sequence[str], retired: Sequence[str],
    places: Mapping[str, Collection[str]], dictionary: DataFrame, build: Mapping[str, object],
) -> dict[tuple, tuple]:
    """Write the changed datasets' rows and rejects, drop what no longer is; returns the row tests of their staging tables."""
    ids, tests, filled = [int(i) for i in changed], {}, set()
    replace.removed(spark, [f"{root}/rejects/dataset_id={i}" for i in [*changed, *retired]])
    if ids:
        mine = records.where(F.regexp_extract("path", fv.RAW_FILE_ID_PATTERN, 1).try_cast("int").isin(ids))
        some = {i: sources[i] for i in ids}
        staging = checks.observed_staging(ingest.scan_audited(spark, mine, sources=some, **build))
        counts = Observation()
        plain = wh.demography_atomic(staging.frame, dictionary)
        wanted = sorted({(i, m) for i in changed for m in places[i]})
        held = [F.count_if((F.col("dataset_id") == int(i)) & (F.col("metric_key") == m)).alias(f"n{k}") for k, (i, m) in enumerate(wanted)]
        rows = plain.observe(counts, F.count(F.lit(1)).alias("n"), *held)
        wh.write_atomic(rows, f"{root}/{ATOMIC}", dynamic=True)
        found = metrics_of(counts, plain)
        filled = {place for k, place in enumerate(wanted) if found[f"n{k}"]}
        mine_only = {f"stg_sdmx_{i}_long" for i in ids}
        tests = {row[:3]: row for row in staging.report() if row[0] in mine_only}
        left = ingest.rejected_audited(spark, mine, sources=some, **build)
        left.write.mode("append").partitionBy("dataset_id").parquet(f"{root}/rejects")
        # the names of the changed datasets only; the dimension is derived from these counts
        stored = wh.read_atomic(spark, f"{root}/{ATOMIC}").where(F.col("dataset_id").isin(ids))
        if filled:
            _write_names(stored.where(F.concat_ws("/", "dataset_id", "metric_key").isin([f"{i}/{m}" for i, m in filled])), f"{root}/{NAMES}")
    nameless = set(places) - {i for i, _ in filled}
    replace.removed(spark, [f"{root}/{NAMES}/dataset_id={i}" for i in nameless])
    # partitions that only an earlier state filled
    old = [(i, m) for i, found in places.items() for m in found if (i, m) not in filled]
    replace.removed(spark, [f"{root}/{ATOMIC}/metric_key={m}/dataset_id={i}" for i, m in old])
    return tests


NAMES_SCHEMA = "geo_code bigint, geo_name_raw string, n_rows bigint, dataset_id int"


def _write_names(atomic: DataFrame, path: str) -> None:
    """How often each dataset names a geography how; replaces the partitions of the datasets in the rows."""
    counts = dimension.name_counts(atomic, "geo_code", "geo_name_raw", "dataset_id")
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset_id").parquet(path)


def read_tests(spark: SparkSession, root: str) -> dict[tuple, tuple]:
    """Row tests as counted at the last write of each table, by table, column and test."""
    if not replace.exists(spark, f"{root}/{TESTS}"):
        return {}
    return {tuple(r)[:3]: tuple(r) for r in spark.read.schema(REPORT).parquet(f"{root}/{TESTS}").collect()}


def write_tests(spark: SparkSession, root: str, tests: Mapping[tuple, tuple]) -> None:
    rows = spark.createDataFrame(list(tests.values()), REPORT).coalesce(1)
    replace.replaced(spark, f"{root}/{TESTS}", lambda path: rows.write.parquet(path))
