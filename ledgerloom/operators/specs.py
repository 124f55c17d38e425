"""What a model is made of. The builders in this package take one of these and DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.keys import entity_key, joined_hash
from ledgerloom.sources.tables import INGESTED_AT


@dataclass(frozen=True)
class Hub:
    """Distinct business keys of one source table."""

    name: str
    table: str
    key: str
    hash_key: str

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key,)

    def hash(self, record_source: Column) -> Column:
        return entity_key(record_source, F.col(self.key))


@dataclass(frozen=True)
class Role:
    """One side of a relationship: the source column and the hash key it becomes."""

    column: str
    hash_key: str


@dataclass(frozen=True)
class Link:
    """Distinct combinations of business keys found together in one source table.

    ``child`` is a key without a hub of its own which takes part in the relationship hash, between
    the two roles. ``not_blank`` lists columns whose blank values mean "no relationship".
    """

    name: str
    table: str
    roles: tuple[Role, Role]
    hash_key: str
    child: str | None = None
    not_blank: tuple[str, ...] = ()
    seen_at: str = INGESTED_AT

    @property
    def columns(self) -> tuple[str, ...]:
        child = (self.child,) if self.child else ()
        return child + tuple(role.column for role in self.roles)

    def role_keys(self, record_source: Column) -> list[Column]:
        return [
            entity_key(record_source, F.col(role.column)).alias(role.hash_key)
            for role in self.roles
        ]

    def hash(self, record_source: Column) -> Column:
        first, second = self.role_keys(record_source)
        child = [F.col(self.child)] if self.child else []
        return joined_hash(first, *child, second)


@dataclass(frozen=True)
class Attribute:
    """A satellite attribute; ``as_text`` casts it to text inside the change hash."""

    name: str
    as_text: bool = False


@dataclass(frozen=True)
class Satellite:
    """Versions of the attributes of a hub or link, one per change between captures."""

    name: str
    table: str
    parent: Hub | Link
    label: str
    attributes: Sequence[Attribute]

    @property
    def hash_key(self) -> str:
        return self.parent.hash_key

    @property
    def attribute_names(self) -> list[str]:
        return [attribute.name for attribute in self.attributes]

    @property
    def hashed(self) -> list[tuple[str, bool]]:
        return [(attribute.name, attribute.as_text) for attribute in self.attributes]


@dataclass(frozen=True)
class Status:
    """Appearance and disappearance of a relationship across captures.

    ``per_source`` compares a relationship only with captures of its own source system. Without it
    every capture counts, so a capture of one source closes the relationships of the others.
    """

    name: str
    link: Link
    per_source: bool = False


@dataclass(frozen=True)
class PointInTime:
    """Which satellite version of a hub is valid from which capture on."""

    name: str
    hub: Hub
    satellite: Satellite
    pointer: str
