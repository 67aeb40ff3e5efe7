"""What is particular about one feed, as data."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql.types import StructType

from millrace.functions.clean import STORED_TYPES
from millrace.functions.names import (
    BROKERAGE_DATE_WORDS,
    BROKERAGE_NUMBER_WORDS,
    TRANSACTION_DATE_WORDS,
    TRANSACTION_NUMBER_WORDS,
)
from millrace.operators.merge import present_keys
from millrace.operators.schema import LINEAGE, dynamic_kinds
from millrace.sources.snapshot import date_part, hash_part

POLICIES = (
    "upsert", "append", "contact_only", "if_changed", "last_wins", "dynamic_key", "declared_key",
)


@dataclass(frozen=True)
class FeedSpec:
    """One feed: its columns, its key, its duplicate rule and its merge policy.

    ``kinds`` maps each data column to a cleaning kind. ``update`` lists the columns a match changes;
    None means all but the key and ``created_at``. ``overrides`` replaces the kind of single columns. ``limits`` are
    columns of the target as DDL, with what it refuses: ``NOT NULL``, ``varchar(n)``, ``decimal(p, s)``. The input of a
    ``workbook`` feed may be a folder named like a workbook, with a file per sheet in the order of their names.
    """

    code: str
    table: str
    kinds: dict[str, str]
    keys: tuple[str, ...] = ()
    policy: str = "upsert"
    in_file: str | None = None
    update: tuple[str, ...] | None = None
    tracked: tuple[str, ...] = ()
    complete_key: bool = False
    key_declared: bool = True
    dynamic: bool = False
    part_date: str | None = None
    buckets: int = 64
    date_words: tuple[str, ...] = TRANSACTION_DATE_WORDS
    number_words: tuple[str, ...] = TRANSACTION_NUMBER_WORDS
    overrides: dict[str, str] = field(default_factory=dict)
    limits: str = ""
    workbook: bool = False

    def __post_init__(self):
        if self.policy not in POLICIES:
            raise ValueError(f"{self.code}: unknown policy {self.policy}")
        missing = [c for c in (*self.tracked, *(self.update or ())) if c not in self.columns]
        if missing:
            raise ValueError(f"{self.code}: no such columns {missing}")

    @property
    def cleaning(self) -> dict[str, str]:
        return {**self.kinds, **self.overrides}

    @property
    def columns(self) -> list[str]:
        return [*self.kinds, *LINEAGE]

    @property
    def merge_keys(self) -> list[str]:
        """The key columns the merge matches on."""
        if self.policy == "append" or (self.policy == "declared_key" and not self.key_declared):
            return []
        if self.policy == "dynamic_key":
            return present_keys(list(self.keys), list(self.kinds))
        return list(self.keys)

    @property
    def update_columns(self) -> list[str]:
        keys = set(self.keys)
        if self.update is not None:
            return list(self.update)
        if self.policy == "dynamic_key":
            keys |= {"file_path"}
        return [c for c in self.columns if c not in keys and c != "created_at"]

    @property
    def schema(self) -> StructType:
        data = [f"`{name}` {STORED_TYPES[kind]}" for name, kind in self.cleaning.items()]
        return StructType.fromDDL(
            ", ".join([*data, "file_path string", "created_at timestamp", "updated_at timestamp"])
        )

    @property
    def part(self) -> Column:
        """Partition of a row in the stored table; equal keys always fall into the same one."""
        if self.part_date is not None and self.part_date in self.kinds:
            return date_part(self.part_date)
        return hash_part(list(self.keys) or list(self.kinds)[:1], self.buckets)

    def for_catalog(self, target: StructType) -> FeedSpec:
        """The same feed with the columns of a stored table; types are chosen by keyword."""
        return replace(
            self,
            kinds=dynamic_kinds(target, date_words=self.date_words, number_words=self.number_words),
        )


def brokerage_words() -> dict[str, tuple[str, ...]]:
    return {"date_words": BROKERAGE_DATE_WORDS, "number_words": BROKERAGE_NUMBER_WORDS}
