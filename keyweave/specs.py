"""Declared keys and relationships. Spark tables carry no primary or foreign keys, so they are stated here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    ref_column: str

    @property
    def target(self) -> str:
        return f"{self.table}.{self.ref_column}"


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    indexes: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)

    def foreign_key(self, column: str) -> ForeignKey | None:
        return next((fk for fk in self.foreign_keys if fk.column == column), None)


@dataclass(frozen=True)
class IndexSpec:
    """A sparse secondary key: only items holding ``partition`` belong to the index."""

    name: str
    partition: str
    sort: str


@dataclass(frozen=True)
class CollectionSpec:
    name: str
    label: str
    sources: tuple[str, ...]
    entities: tuple[str, ...]
    key_prefixes: tuple[str, ...]
    required: dict[str, tuple[str, ...]]
    counted: tuple[str, ...]
    indexes: tuple[IndexSpec, ...] = ()
    partition: str = "PK"
    sort: str = "SK"
    exact_count: bool = False
    may_be_empty: bool = False

    def index(self, name: str) -> IndexSpec:
        for candidate in self.indexes:
            if candidate.name == name:
                return candidate
        raise ValueError(f"{self.name} has no index {name}")
