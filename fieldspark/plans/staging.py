"""Staging: raw strings to typed, deduplicated, reference-flagged tables.

Rows are cleaned, reduced to their latest version and only then flagged, so the flag
joins see each row once. Deduplication keeps one row per key, so a staged parent holds
exactly the keys of its raw table: once it is written, flags can use its key column,
with no distinct and no second scan of the raw file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.casts import ident, misread, number_or_error
from fieldspark.functions.dates import mixed_timestamp
from fieldspark.functions.text import category
from fieldspark.operators.dedup import keep_latest
from fieldspark.operators.keys import highest_per_key, key_set, with_fk_flag
from fieldspark.operators.lookup import lookup
from fieldspark.plans.describe import described
from fieldspark.plans.entities import CLIENTS, ENTITIES, Entity, Settings

VERSION = "_version"
#: Before the name of a late number: the text that is no number, and the number or an error.
BAD, STRICT = "_bad_", "_strict_"


def versions(raw: DataFrame, entity: Entity, settings: Settings) -> DataFrame:
    """Cleaned columns of every raw row. The version is parsed once, as a timestamp; the staged date
    follows from it. A late number is null where it is bad, with the bad text beside it."""
    version = mixed_timestamp(F.col(entity.version)).alias(VERSION)
    lenient = replace(settings, strict_ids=False)
    columns = [c.build(lenient if c.late else settings) for c in entity.cleaned if c.name != entity.version]
    late = [c for c in entity.cleaned if c.late and settings.strict_ids]
    return raw.select(*columns, *[misread(F.col(c.raw or c.name)).alias(f"{BAD}{c.name}") for c in late], version)


def strict_numbers(df: DataFrame, entity: Entity) -> dict[str, Column]:
    """The late numbers of ``versions``, with an error where one is bad."""
    found = [c.name for c in entity.cleaned if f"{BAD}{c.name}" in df.columns]
    return {f"{STRICT}{n}": number_or_error(F.col(n), F.col(f"{BAD}{n}")) for n in found}


def dated(latest: DataFrame, entity: Entity) -> DataFrame:
    """The rows with the staged date in place of their version, and late numbers that must be good."""
    names = {c.name for c in entity.cleaned}
    flags = [c for c in latest.columns if c != VERSION and c not in names and not c.startswith((BAD, STRICT))]
    made = {c.name: F.col(c.name) for c in entity.cleaned if c.name != entity.version}
    made |= {n.removeprefix(STRICT): F.col(n) if n in latest.columns else c for n, c in strict_numbers(latest, entity).items()}
    made[entity.version] = F.col(VERSION).cast("date")
    return latest.select(*[made[c.name].alias(c.name) for c in entity.cleaned], *flags)


def cleaned_latest(raw: DataFrame, entity: Entity, settings: Settings) -> DataFrame:
    """Cleaned columns, latest version per key. Late numbers of all versions must be good, where they are
    read: the order of the versions does without the strict ones, so that otherwise they are left out."""
    found = versions(raw, entity, settings)
    strict = strict_numbers(found, entity)
    return dated(keep_latest(found.withColumns(strict) if strict else found, entity.key, VERSION, strict), entity)


def finished(df: DataFrame, entity: Entity, settings: Settings) -> DataFrame:
    """The staged columns in order, with what follows from the others and the day."""
    added = entity.derived(settings)
    complete = df.withColumns(added) if added else df
    return complete.select(*described(entity.output, entity.comments()))


def raw_keys(name: str, raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The distinct keys of a raw table, under the staged key's name."""
    key = ENTITIES[name].key
    return key_set(raw, ident(F.col(key), settings.id_type, settings.strict_ids), key)


def stage(
    name: str,
    raw: DataFrame,
    parents: Mapping[str, DataFrame] | None = None,
    settings: Settings = Settings(),
    kept: Callable[[DataFrame], DataFrame] = lambda latest: latest,
) -> DataFrame:
    """Stage one raw table. ``parents`` holds, per entity it refers to, a DataFrame with
    that entity's key column, each key once: the staged table, or ``raw_keys``. ``kept`` may write the
    deduplicated rows before they are flagged, and gives them as read back."""
    entity = ENTITIES[name]
    latest = df = kept(cleaned_latest(raw, entity, settings))
    for ref in entity.references:
        # Hot keys are looked for in the deduplicated rows: the plan reuses their shuffle, or reads them as written.
        df = with_fk_flag(
            df, ref.fk, parents[ref.parent], ENTITIES[ref.parent].key, ref.flag,
            null_fk=ref.null_fk, hot_from=latest, spread_by=[entity.key],
        )
    return finished(df, entity, settings)


def stage_clients(
    raw_clients: DataFrame, raw_projects: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Stage clients, taking their code from the raw projects (all versions)."""
    clients = cleaned_latest(raw_clients, CLIENTS, settings)
    codes = highest_per_key(
        raw_projects,
        ident(F.col("client_id"), settings.id_type, settings.strict_ids),
        category(F.col("client_code")),
        "_client_id",
        "client_code",
    )
    coded = lookup(clients, codes, "client_id", "_client_id")
    return finished(coded, CLIENTS, settings)


class StagedTables(Mapping[str, DataFrame]):
    """All staging tables as lazy plans over the raw tables; a plan is made when first used."""

    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings = Settings()) -> None:
        self._raw, self._settings = raw, settings
        self._made: dict[str, DataFrame] = {}

    def _make(self, name: str) -> DataFrame:
        if name == "clients":
            return stage_clients(self._raw["clients"], self._raw["projects"], self._settings)
        parents = {
            ref.parent: raw_keys(ref.parent, self._raw[ref.parent], self._settings)
            for ref in ENTITIES[name].references
        }
        return stage(name, self._raw[name], parents, self._settings)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)
