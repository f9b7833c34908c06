"""The stored layers: Parquet tables at ``<root>/<layer>/<table>``.

Bronze is partitioned by ``extraction_month``.  Every write conforms the rows
to the declared schema and returns how many rows it wrote, observed during the
write itself.  What replaces stored rows is written whole beside them first and
then takes their place by renaming folders: a write that fails leaves them as
they were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.in_place import AT, FILE, at_places, bitmaps, placed
from kerbside.operators.keep_first import keep_first
from kerbside.operators.settle import STORED_AS, settled
from kerbside.operators.upsert import insert_new, upsert
from kerbside.schemas import AUDIT_COLUMNS, all_tables, schema_of
from kerbside.sources.files import child_names, delete_tree, move, path_exists

MONTH = "extraction_month"
PUSHED_KEYS = 10  # as many as the scan compares one by one with a row group's filters
BY_MONTH = ("bronze", "partials")  # layers in folders by month
OPEN_MONTHS = 32  # files that a task writes side by side; what has more months is sorted


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a missing column is null."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def audit(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Creation and update time: one value for a whole table write."""
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumns({c: stamp for c in AUDIT_COLUMNS})


def together(spark: SparkSession, work: Mapping[str, Callable[[], int]], at_once: int = 4) -> dict[str, int]:
    """Submit independent writes side by side, so one job's tail does not idle the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in work.items()}
        return {name: future.result() for name, future in running.items()}


class Warehouse:
    """Typed reads and idempotent writes below one root folder."""

    def __init__(self, spark: SparkSession, root: str, key_filters: Sequence[str] = ()):
        """``key_filters`` names columns whose Parquet Bloom filters are written, so that few keys are found cheaply."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.key_filters = tuple(key_filters)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    def tables(self) -> list[tuple[str, str]]:
        """Declared tables that are stored, in layer order."""
        return [(layer, table) for layer, table in all_tables() if self.exists(layer, table)]

    def stored_months(self, table: str, layer: str = "bronze") -> list[str]:
        """Months of a table by month, from its partition folders alone."""
        names = child_names(self.spark, self.path(layer, table))
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{MONTH}=")]

    def read(self, layer: str, table: str, columns: Sequence[str] | None = None,
             where: Column | str | None = None) -> DataFrame:
        """A stored table; an absent one reads as empty with its declared schema.

        Projection and predicate are part of the plan and reach the scan.
        """
        schema = schema_of(layer, table)
        if self.exists(layer, table):
            df = self.spark.read.schema(schema).parquet(self.path(layer, table))
        else:
            df = self.spark.createDataFrame([], schema)
        if where is not None:
            df = df.where(where)
        return df.select(*(columns or schema.fieldNames()))

    def create(self, layer: str, table: str) -> None:
        """Store an empty table if there is none; an existing one is left alone."""
        if not self.exists(layer, table):
            self._store(self.spark.createDataFrame([], schema_of(layer, table)), self.path(layer, table), "append",
                        by_month=layer in BY_MONTH)

    def append(self, df: DataFrame, layer: str, table: str, *, dealt: bool = False) -> int:
        """Add rows to an existing table; loading the same rows twice stores them twice.  ``dealt`` as in ``stage_months``."""
        if not self.exists(layer, table):
            raise ValueError(f"no table {layer}.{table}: create it first")
        return self._store(conform(df, schema_of(layer, table)), self.path(layer, table), "append",
                           by_month=layer in BY_MONTH, dealt=dealt)

    def _aside(self, layer: str, table: str) -> str:
        """A new folder below the root; names with a leading underscore are no tables."""
        return f"{self.root}/_writing/{layer}-{table}-{uuid4().hex}"

    def _swap(self, new: str | None, target: str) -> None:
        """``new`` in the place of ``target``; without ``new`` the target goes."""
        old = self._aside("replaced", "folder")
        had = path_exists(self.spark, target)
        if had:
            move(self.spark, target, old)
        try:
            if new is not None:
                move(self.spark, new, target)
        except Exception:
            if had:
                move(self.spark, old, target)
            raise
        if had:
            delete_tree(self.spark, old)

    def overwrite(self, df: DataFrame, layer: str, table: str, *, keep_on_empty: bool = False) -> int:
        """Replace a table.  An empty result empties it, unless ``keep_on_empty``."""
        rows = conform(df, schema_of(layer, table))
        new = self._aside(layer, table)
        written = self._store(rows, new, "errorifexists", by_month=layer in BY_MONTH)
        if written == 0 and keep_on_empty:
            delete_tree(self.spark, new)
        else:
            self._swap(new, self.path(layer, table))
        return written

    def stage_months(self, df: DataFrame, table: str, layer: str = "bronze", *, dealt: bool = False) -> StagedMonths:
        """Write the rows of some months of a table beside it, by month; nothing is replaced yet.

        ``dealt`` says that the rows lie by month already, so that a task has few of them.
        """
        path = self._aside(layer, table)
        rows = self._store(conform(df, schema_of(layer, table)), path, "errorifexists", by_month=True, dealt=dealt)
        return StagedMonths(self, table, path, rows, layer)

    def replace_months(self, df: DataFrame, table: str, months: Sequence[str], *, dealt: bool = False) -> int:
        """Replace the given months of a Bronze table, also those without a row in ``df``."""
        staged = self.stage_months(df.where(F.col(MONTH).isin(list(months))), table, dealt=dealt)
        staged.put(months)
        return staged.rows

    def replace_month(self, df: DataFrame, table: str, month: str) -> int:
        """Replace one month of a Bronze table, also when the month has no rows."""
        return self.replace_months(df, table, [month])

    def upsert(self, updates: DataFrame, layer: str, table: str, keys: Sequence[str],
               newest_first: Sequence[str | Column], *, dealt: bool = False) -> int:
        """Merge by key, latest wins; rows written.

        Of a table by month only the folders are rewritten that hold an updated key or get an update; all others keep
        their files.  The updates are stored by month aside; which of them and of the stored rows stay is found from
        keys and places alone.  ``dealt`` says that the updates lie by month already: then no row is moved, and a
        month keeps about as many files as its parts came from.  Otherwise rows are rebalanced by month on their way in
        and out.  Another table is written whole before it replaces its own input.
        """
        schema = schema_of(layer, table)
        rows = conform(updates, schema)
        if layer not in BY_MONTH:
            return self.overwrite(upsert(self.read(layer, table), rows, keys, newest_first), layer, table)
        aside = self.stage_months(rows, table, layer, dealt=dealt)
        try:
            came = self.spark.read.schema(schema).parquet(aside.path)
            with settled(keep_first(placed(came), keys, newest_first).select(*keys, MONTH, FILE, AT), "newest") as newest:
                months, gone = self._touched(newest, layer, table, keys)
                kept = self.read(layer, table, where=F.col(MONTH).isin(months))
                if gone is not None:
                    kept = at_places(kept, gone, chosen=False)
                merged = kept.unionByName(at_places(came, bitmaps(newest.select(FILE, AT))).select(*kept.columns))
                staged = self.stage_months(merged, table, layer, dealt=dealt)
                staged.put(months)
                return staged.rows
        finally:
            aside.discard()

    def touched_months(self, updates: DataFrame, layer: str, table: str, keys: Sequence[str]) -> list[str]:
        """Months of a table that an upsert changes."""
        return self._touched(updates, layer, table, keys)[0]

    def _touched(self, updates: DataFrame, layer: str, table: str, keys: Sequence[str]) -> tuple[list[str], DataFrame | None]:
        """Months that an upsert changes and bitmaps of the stored rows it replaces (none for an absent table): from the
        key columns alone, with a pushed filter for few keys."""
        own = {r[0] for r in updates.select(MONTH).distinct().collect()}  # calendar months
        if None in own:
            raise ValueError(f"an update of {layer}.{table} has no {MONTH}")
        if not self.exists(layer, table):
            return sorted(own), None
        stored = placed(self.read(layer, table, [*keys, MONTH]))
        some = updates.select(keys[0]).distinct().limit(PUSHED_KEYS + 1).collect()
        if len(some) <= PUSHED_KEYS and all(r[0] is not None for r in some):
            stored = stored.where(F.col(keys[0]).isin([r[0] for r in some]))
        changed = updates.select(*keys)
        same = reduce(lambda a, b: a & b, [stored[k].eqNullSafe(changed[k]) for k in keys])
        gone = bitmaps(stored.join(changed, same, "left_semi").select(FILE, AT, MONTH), MONTH)
        return sorted(own | {r[0] for r in gone.select(MONTH).distinct().collect()}), gone

    def add_new(self, df: DataFrame, table: str, keys: Sequence[str], months: Sequence[str]) -> int:
        """Append the rows whose key is not stored yet in their month.

        ``months`` are those the rows belong to: only their partitions are read.
        """
        self.create("bronze", table)
        rows = conform(df, schema_of("bronze", table))
        stored = self.read("bronze", table, where=F.col(MONTH).isin(list(months)))
        return self.append(insert_new(stored, rows, keys), "bronze", table)

    def key_map(self, name: str, key: str) -> DataFrame:
        """Stored (key, name) of every name that ever got an id; empty if none has."""
        path = f"{self.root}/keys/{name}"
        schema = f"{key} bigint, name string"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def has_key_maps(self) -> bool:
        return path_exists(self.spark, f"{self.root}/keys")

    def add_keys(self, rows: DataFrame, name: str) -> int:
        """Add names to a key map in one committed write."""
        return self._store(rows, f"{self.root}/keys/{name}", "append")

    def as_of_month(self, table: str, month: str) -> DataFrame:
        """Bronze rows loaded up to a month; Silver and Gold built on them show that state."""
        return self.read("bronze", table, where=F.col(MONTH) <= month)

    def _store(self, df: DataFrame, path: str, mode: str, *, by_month: bool = False, dealt: bool = False) -> int:
        """By month, rows are rebalanced first unless ``dealt`` by it: small months share a file writer, and a month too
        large for one is split by adaptive execution.  Otherwise every task would write a file per month."""
        seen = Observation()
        rows = df.hint("rebalance", MONTH) if by_month and not dealt else df
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**STORED_AS)
        for column in set(self.key_filters) & set(df.columns):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        if dealt:
            # A task keeps a file open for each of its months, instead of sorting what a whole scan task has by month.
            self.spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_MONTHS)
        (writer.partitionBy(MONTH) if by_month else writer).parquet(path)
        return seen.get["rows"]


@dataclass(frozen=True)
class StagedMonths:
    """Rows of a table by month written beside it, to take the place of the months they belong to."""

    warehouse: Warehouse
    table: str
    path: str
    rows: int
    layer: str = "bronze"

    def put(self, months: Sequence[str]) -> None:
        """Swap in these months; one that has no rows here is emptied.  Only folders are renamed."""
        spark, target = self.warehouse.spark, self.warehouse.path(self.layer, self.table)
        if not self.warehouse.exists(self.layer, self.table):
            self.warehouse.create(self.layer, self.table)
        here = set(child_names(spark, self.path))
        for month in months:
            name = f"{MONTH}={month}"
            self.warehouse._swap(f"{self.path}/{name}" if name in here else None, f"{target}/{name}")
        self.discard()

    def discard(self) -> None:
        delete_tree(self.warehouse.spark, self.path)
