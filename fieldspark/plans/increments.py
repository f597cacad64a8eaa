"""Staging kept up to date by merging new raw rows, instead of being built anew.

The latest version of every row is stored by entity in buckets of its key. New raw rows touch the
buckets of their keys; those are merged and written, the others are left where they are. A row whose
reference was invalid becomes valid when its parent arrives, so buckets with such rows are touched too.
What follows from the day of the run is added when a table is read.

The files of a merge lie in a folder of their own, and one manifest names the folder of every bucket.
The manifest is switched at the end, so readers see all of a merge or nothing. Merging the same rows
again changes nothing, so a run that failed is simply run again.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.casts import ident
from fieldspark.functions.text import category
from fieldspark.operators.dedup import keep_latest
from fieldspark.operators.keys import highest_per_key, with_fk_flag
from fieldspark.operators.lookup import lookup
from fieldspark.plans.entities import ENTITIES, Entity, Settings
from fieldspark.plans.staging import VERSION, dated, finished, versions
from fieldspark.sources.tables import Warehouse, delete_folder, folders

#: Entities that don't need each other and are merged at the same time.
PARALLEL_MERGES = 4
LAYER, INCOMING = "versions", "incoming"
#: Client codes by client id, over all versions of all projects.
CODES, CODES_KEY = "client_codes", "_client_id"
_BUCKET = "_key_bucket"


class StagingStore:
    """The stored versions of a warehouse. ``buckets`` is fixed by the first merge of an entity: some
    256 MB of a bucket are a good size."""

    def __init__(self, house: Warehouse, settings: Settings = Settings(), buckets: int = 64) -> None:
        self._house, self._settings, self._buckets = house, settings, buckets

    # --- buckets

    def _manifest(self, name: str) -> dict[int, str]:
        """The folder of every bucket that holds rows."""
        if not self._house.exists(LAYER, name):
            return {}
        rows = self._house.read(LAYER, name).collect()  # one row a bucket
        if rows and rows[0].buckets != self._buckets:
            raise ValueError(f"{name} is stored in {rows[0].buckets} buckets, not {self._buckets}")
        return {r.bucket: r.version for r in rows}

    def _folder(self, name: str, version: str) -> str:
        return self._house.version_path(LAYER, f"{name}_rows", version)

    def _rows(self, name: str, schema: T.StructType, only: Collection[int] | None = None) -> DataFrame:
        """Stored rows, of some buckets or of all."""
        paths = [
            f"{self._folder(name, version)}/{_BUCKET}={bucket}"
            for bucket, version in sorted(self._manifest(name).items()) if only is None or bucket in only
        ]
        spark = self._house.spark
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self._buckets)).cast("int")

    def _buckets_of(self, df: DataFrame, key: str) -> set[int]:
        return {r[0] for r in df.select(self._bucket(key)).distinct().collect()}  # no more than there are buckets

    def _replace(self, name: str, key: str, rows: DataFrame, touched: set[int]) -> None:
        """Write the touched buckets and switch to them."""
        version = self._house.new_version()
        bucketed = rows.withColumn(_BUCKET, self._bucket(key))
        bucketed.repartition(max(1, len(touched)), _BUCKET).write.partitionBy(_BUCKET).parquet(self._folder(name, version))
        manifest = {**self._manifest(name), **{b: version for b in touched}}
        table = [(b, v, self._buckets) for b, v in sorted(manifest.items())]
        self._house.write(LAYER, name, self._house.spark.createDataFrame(table, "bucket int, version string, buckets int").coalesce(1))

    def vacuum(self, name: str) -> None:
        """Delete buckets that the manifest no longer names. No query may still read the table as it was."""
        current = {f"{version}/{_BUCKET}={bucket}" for bucket, version in self._manifest(name).items()}
        for version in folders(self._house.spark, self._folder(name, "").rstrip("/")):
            for bucket in folders(self._house.spark, self._folder(name, version)):
                if f"{version}/{bucket}" not in current:
                    delete_folder(self._house.spark, f"{self._folder(name, version)}/{bucket}")

    # --- entities

    def _schema(self, entity: Entity) -> T.StructType:
        """The columns stored for an entity: cleaned ones, the version and flags."""
        nothing = T.StructType([T.StructField(c.raw or c.name, T.StringType()) for c in entity.cleaned])
        wanted = {f.name: f for f in nothing}
        for c in (entity.version, entity.key):
            wanted.setdefault(c, T.StructField(c, T.StringType()))
        empty = self._house.spark.createDataFrame([], T.StructType(list(wanted.values())))
        cleaned = versions(empty, entity, self._settings).schema
        fields = [T.StructField(f.name, f.dataType) for f in cleaned]
        return T.StructType(fields + [T.StructField(r.flag, T.BooleanType()) for r in entity.references])

    def _stored(self, entity: Entity, only: Collection[int] | None = None) -> DataFrame:
        return self._rows(entity.name, self._schema(entity), only)

    def _stale(self, entity: Entity, arrived: Mapping[str, DataFrame]) -> set[int]:
        """Buckets with rows whose invalid reference is among the parents that arrived."""
        found: set[int] = set()
        for ref in entity.references:
            if ref.parent in arrived:
                keys = arrived[ref.parent].select(F.col(ENTITIES[ref.parent].key).alias("_parent"))
                invalid = self._stored(entity).where(~F.col(ref.flag) & F.col(ref.fk).isNotNull())
                found |= self._buckets_of(invalid.join(keys, F.col(ref.fk) == F.col("_parent"), "left_semi"), entity.key)
        return found

    def _merge_entity(self, entity: Entity, incoming: DataFrame | None, arrived: Mapping[str, DataFrame]) -> set[int]:
        touched = self._stale(entity, arrived)
        if incoming is not None:
            touched |= self._buckets_of(incoming, entity.key)
        if not touched:
            return touched
        kept = self._stored(entity, touched).drop(*[r.flag for r in entity.references])
        rows = kept if incoming is None else keep_latest(kept.unionByName(incoming), entity.key, VERSION)
        for ref in entity.references:
            parent = ENTITIES[ref.parent]
            keys = self._stored(parent).select(parent.key)
            rows = with_fk_flag(rows, ref.fk, keys, parent.key, ref.flag, null_fk=ref.null_fk)
        self._replace(entity.name, entity.key, rows, touched)
        return touched

    def _merge_codes(self, projects: DataFrame) -> None:
        s = self._settings
        codes = highest_per_key(
            projects, ident(F.col("client_id"), s.id_type, s.strict_ids), category(F.col("client_code")), CODES_KEY, "client_code"
        ).where(F.col("client_code").isNotNull())
        codes = self._house.write(INCOMING, CODES, codes)
        touched = self._buckets_of(codes, CODES_KEY)
        if touched:
            both = self._rows(CODES, codes.schema, touched).unionByName(codes)
            self._replace(CODES, CODES_KEY, both.groupBy(CODES_KEY).agg(F.max("client_code").alias("client_code")), touched)

    def merge(self, raw: Mapping[str, DataFrame]) -> dict[str, set[int]]:
        """Merge new rows of raw tables (all rows at first) and return the touched buckets by entity.
        Tables without news may be left out."""
        arrived: dict[str, DataFrame] = {}
        touched: dict[str, set[int]] = {}
        if "projects" in raw:
            self._merge_codes(raw["projects"])

        def one(entity: Entity) -> set[int]:
            if entity.name in raw:
                latest = keep_latest(versions(raw[entity.name], entity, self._settings), entity.key, VERSION)
                arrived[entity.name] = self._house.write(INCOMING, entity.name, latest)
            return self._merge_entity(entity, arrived.get(entity.name), arrived)

        with ThreadPoolExecutor(max_workers=PARALLEL_MERGES) as pool:
            while waiting := [e for n, e in ENTITIES.items() if n not in touched]:
                ready = [e for e in waiting if all(ref.parent in touched for ref in e.references)]
                touched |= dict(zip([e.name for e in ready], pool.map(one, ready)))
        return touched

    def read(self, name: str) -> DataFrame:
        """A staging table, as a build from all raw rows would give it."""
        entity = ENTITIES[name]
        rows = dated(self._stored(entity), entity)
        if name == "clients":
            kind = rows.schema[entity.key].dataType
            schema = T.StructType([T.StructField(CODES_KEY, kind), T.StructField("client_code", T.StringType())])
            rows = lookup(rows, self._rows(CODES, schema), "client_id", CODES_KEY)
        return finished(rows, entity, self._settings)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in ENTITIES}


def merged(house: Warehouse, parts: list[Mapping[str, DataFrame]], settings: Settings, buckets: int = 64) -> StagingStore:
    """A store after one merge after the other."""
    store = StagingStore(house, settings, buckets)
    return reduce(lambda s, raw: (s.merge(raw), s)[1], parts, store)
