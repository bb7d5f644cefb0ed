"""Dataset filters (P-1 .. P-7): three-level glob include / exclude.

A filter is a list of rules for each of its two sides. A rule is a path of globs:
``(database,)`` covers a whole database, ``(database, schema)`` a schema,
``(database, schema, table)`` tables. Configuration writes the paths as nested
mappings; rule tables (``side, db, schema, table``, null below what a rule names) hold
any number of them. Two ways apply a filter:

* ``include_table`` and its like make one boolean Column of a configured filter;
* ``filter_by_rules`` joins names with a rule table by ``globs.glob_pairs``.

``normalized`` and ``merged`` work on paths, ``normalize_rules`` and ``merge_rules``
on rule tables: a rule goes where another one refines it, so that "all" yields to
what the other filter names.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.globs import glob_match, glob_pairs
from lakelens.functions.scalars import col_of

Path = tuple[str, ...]
LEVELS = ("db", "schema", "table")
NOTHING = ""  # last step of a path below which nothing was listed
# Fixed value: the database of sources that have schemas and tables alone.
DUMMY_DATABASE = "dummy"


def paths_of(spec, at: Path = ()) -> list[Path]:
    """The paths of nested mappings and sets of globs; None means all below."""
    if spec is None:
        return [at]
    if not spec:
        return [(*at, NOTHING)]
    below = spec.items() if isinstance(spec, Mapping) else [(glob, None) for glob in sorted(spec)]
    return [path for glob, inner in below for path in paths_of(inner, (*at, glob))]


def _refined(paths: Iterable[Path]) -> tuple[Path, ...]:
    """Each path once, in the order in which its databases, schemas and tables first
    came, without those that another path continues."""
    paths, first = list(paths), {}
    for path in paths:
        for n in range(1, len(path) + 1):
            first.setdefault(path[:n], len(first))
    continued = {path[:n] for path in paths for n in range(1, len(path))}
    return tuple(sorted(set(paths) - continued, key=lambda p: [first[p[:n]] for n in range(1, len(p) + 1)]))


@dataclass(frozen=True)
class DatasetFilter:
    """Rules to include (None: everything) and to exclude (None: nothing)."""
    includes: Optional[tuple[Path, ...]] = None
    excludes: Optional[tuple[Path, ...]] = None

    @classmethod
    def of(cls, includes=None, excludes=None) -> DatasetFilter:
        """From configuration: ``{database: {schema: {table, ...} | None} | None}``."""
        return cls(*(None if spec is None else tuple(paths_of(spec)) for spec in (includes, excludes)))

    @classmethod
    def two_level(cls, includes=None, excludes=None) -> DatasetFilter:
        """P-4, from ``{schema: {table, ...} | None}``."""
        return cls.of(*(None if spec is None else {DUMMY_DATABASE: spec} for spec in (includes, excludes)))

    def normalized(self) -> DatasetFilter:
        """P-6: globs in lower case."""
        return DatasetFilter(*(None if side is None else _refined(tuple(glob.lower() for glob in path) for path in side)
                               for side in (self.includes, self.excludes)))

    def merged(self, other: DatasetFilter) -> DatasetFilter:
        """P-6: the rules of both; a side that one filter lacks is the other's."""
        return DatasetFilter(*(None if a is None and b is None else _refined([*(a or ()), *(b or ())])
                               for a, b in ((self.includes, other.includes), (self.excludes, other.excludes))))


def _any(terms: Sequence[Column]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | term
    return found


def _fits(path: Path, names: Sequence[Column]) -> Column:
    found = glob_match(names[0], path[0])
    for name, glob in zip(names[1:], path[1:]):
        found = found & glob_match(name, glob)
    return found


def _covers(paths: Iterable[Path], names: Sequence[Column]) -> Column:
    """Some path fits the names at all its levels."""
    return _any([_fits(path, names) for path in paths if path[-1] != NOTHING])


def include_table(flt: DatasetFilter, db, schema, table) -> Column:
    """P-1: names are lower-cased before matching; includes then excludes."""
    names = [F.lower(col_of(name)) for name in (db, schema, table)]
    kept = F.lit(True) if flt.includes is None else _covers(flt.includes, names)
    return kept if flt.excludes is None else kept & ~_covers(flt.excludes, names)


def include_table_two_level(flt: DatasetFilter, schema, table) -> Column:
    """P-4: schema.table sources, matched under the dummy database."""
    return include_table(flt, F.lit(DUMMY_DATABASE), schema, table)


def _decided(paths: Iterable[Path], names: Sequence[Column], partial: bool) -> Column:
    """The first path that fits as far as its schema decides: a path that goes on to
    tables covers the schema in part."""
    chain = None
    for path in paths:
        schema = [glob for glob in path[:2] if glob != NOTHING]
        value = F.lit(partial if len(path) == 3 and path[2] != NOTHING else True)
        chain = (F if chain is None else chain).when(_fits(schema, names), value)
    return F.lit(False) if chain is None else chain.otherwise(F.lit(False))


def include_schema(flt: DatasetFilter, db, schema) -> Column:
    """P-2: include accepts a partial cover; exclude needs a full cover."""
    names = [F.lower(col_of(name)) for name in (db, schema)]
    kept = F.lit(True) if flt.includes is None else _decided(flt.includes, names, True)
    return kept if flt.excludes is None else kept & ~_decided(flt.excludes, names, False)


def include_database(flt: DatasetFilter, db) -> Column:
    """P-3: only whole-database excludes exclude; any include pattern includes."""
    name = F.lower(col_of(db))
    kept = F.lit(True) if flt.includes is None else _any([glob_match(name, glob) for glob in dict.fromkeys(p[0] for p in flt.includes)])
    whole = [path[0] for path in flt.excludes or () if len(path) == 1 or path[1] == NOTHING]
    return kept & ~_any([glob_match(name, glob) for glob in whole])


# ---- rule tables ---------------------------------------------------------


def rules_frame(spark: SparkSession, flt: DatasetFilter) -> DataFrame:
    """The rule table of a configured filter."""
    rows = [(side, *path, *[None] * (3 - len(path))) for side, paths in (("include", flt.includes), ("exclude", flt.excludes)) for path in paths or ()]
    return spark.createDataFrame(rows, "side string, db string, schema string, table string")


def normalize_rules(rules: DataFrame) -> DataFrame:
    """P-6 on a rule table: globs in lower case, each rule once, none that another
    rule of its side refines."""
    low = rules.select("side", *[F.lower(c).alias(c) for c in LEVELS]).distinct()
    schemas = low.filter("schema IS NOT NULL").select("side", "db").distinct()
    tables = low.filter("table IS NOT NULL").select("side", "db", "schema").distinct()
    return (low.filter("schema IS NULL").join(schemas, ["side", "db"], "left_anti").select(low.columns)
            .unionAll(low.filter("schema IS NOT NULL AND table IS NULL").join(tables, ["side", "db", "schema"], "left_anti").select(low.columns))
            .unionAll(low.filter("table IS NOT NULL")))


def merge_rules(one: DataFrame, other: DataFrame) -> DataFrame:
    """P-6 on rule tables: the normalised rules of both."""
    return normalize_rules(one.select("side", *LEVELS).unionAll(other.select("side", *LEVELS)))


def filter_by_rules(df: DataFrame, rules: DataFrame, db="db", schema="schema", table="table") -> DataFrame:
    """P-1 with a rule table of any size. Names are matched once each, in lower case;
    without include rules everything is included."""
    keyed = df.select("*", *[F.lower(col_of(name)).alias(f"__{level}") for name, level in zip((db, schema, table), LEVELS)])
    own = [f"__{level}" for level in LEVELS]
    low = normalize_rules(rules).filter(F.coalesce("table", "schema", "db") != NOTHING)
    pairs = glob_pairs(keyed.select(own).distinct(), own, low, LEVELS)
    sides = pairs.groupBy(own).agg(F.bool_or(F.col("side") == "include").alias("__in"), F.bool_or(F.col("side") == "exclude").alias("__out"))
    limited = rules.filter("side = 'include'").agg(F.count("*") > 0).scalar()
    sides = sides.select(*[F.col(c).alias(f"{c}_") for c in own], "__in", "__out")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in own]
    met = keyed.join(sides, same, "left")
    kept = met.filter((~limited | F.coalesce("__in", F.lit(False))) & ~F.coalesce("__out", F.lit(False)))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


@dataclass
class TopicFilter:
    includes: Optional[set] = None
    excludes: Optional[set] = None


def include_topic(flt: TopicFilter, topic) -> Column:
    """P-5: topic and globs both in lower case."""
    name = F.lower(col_of(topic))
    some = lambda globs: _any([glob_match(name, glob.lower()) for glob in sorted(globs)])
    kept = F.lit(True) if flt.includes is None else some(flt.includes)
    return kept if flt.excludes is None else kept & ~some(flt.excludes)


# Default system excludes per source family.
DEFAULT_EXCLUDES = {
    "warehouse": {"snowflake": None, "*": {"information_schema": None}},
    "postgres": {"*": {"information_schema": None, "pg_catalog": None}},
    "redshift": {"*": {"information_schema": None, "pg_catalog": None, "pg_internal": None}},
    "trino": {"system": None, "*": {"information_schema": None}},
    "unity": {"system": None, "*": {"information_schema": None}},
    "kafka": {"_schemas", "__consumer_offsets", "_confluent*"},
}


def with_default_excludes(flt: DatasetFilter, family: str) -> DatasetFilter:
    """P-7: merge the family's system excludes, then normalise (so upper-case
    defaults still match lower-cased names)."""
    return flt.merged(DatasetFilter.of(excludes=DEFAULT_EXCLUDES[family])).normalized()
