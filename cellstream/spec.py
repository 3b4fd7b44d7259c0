"""Table specifications: record fields, source types, primary key, salt, families."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Self


@dataclass(frozen=True)
class Field:
    """A record field: name, record type (see functions.coerce), source type (see functions.decode), whether it's skipped."""

    name: str
    kind: object = "string"
    source: str = "VARCHAR"
    skip: bool = False
    default: object = None


@dataclass(frozen=True)
class TableSpec:
    """What a job needs to know of a table; salt is clamped to 0..8, a capacity hint of 0 or less is none."""

    name: str
    fields: tuple[Field, ...]
    pk: tuple[str, ...] = ()
    salt: int = 0
    families: tuple[str, ...] = ()
    hint: int | None = None
    sizes: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "salt", min(8, max(0, self.salt)))
        object.__setattr__(self, "hint", self.hint if self.hint and self.hint > 0 else None)
        for lists in ("pk", "families"):
            object.__setattr__(self, lists, tuple(_distinct(getattr(self, lists))))
        skipped = [p for p in self.pk if any(f.name.lower() == p.lower() and f.skip for f in self.fields)]
        absent = [p for p in self.pk if not any(f.name.lower() == p.lower() for f in self.fields)]
        if skipped or absent:
            raise ValueError(f"{self.name}: primary key columns skipped {skipped} or not declared {absent}")

    def of(self, name: str) -> Field | None:
        """The field of a column name, without regard to case and outer blanks."""
        return next((f for f in self.fields if f.name.lower() == name.strip().lower()), None)

    def values(self) -> list[Field]:
        """Fields filled from cells."""
        keys = {p.lower() for p in self.pk}
        return [f for f in self.fields if not f.skip and f.name.lower() not in keys and not f.name.startswith("_")]

    def meta(self) -> set[str]:
        return {f.name for f in self.fields if f.name.startswith("_")}

    @classmethod
    def builder(cls, name: str) -> SpecBuilder:
        return SpecBuilder(name)


class SpecBuilder:
    """Builds a TableSpec step by step."""

    def __init__(self, name: str):
        self._name, self._fields, self._more = name, [], {}

    def column(self, name: str, kind: object = "string", source: str = "VARCHAR", **more: object) -> Self:
        self._fields.append(Field(name, kind, source, **more))
        return self

    def key(self, *names: str) -> Self:
        self._more["pk"] = names
        return self

    def salted(self, n: int) -> Self:
        self._more["salt"] = n
        return self

    def only(self, *families: str) -> Self:
        self._more["families"] = families
        return self

    def wide(self, hint: int) -> Self:
        self._more["hint"] = hint
        return self

    def build(self) -> TableSpec:
        return TableSpec(self._name, tuple(self._fields), **self._more)


def _distinct(names: tuple[str, ...]) -> list[str]:
    seen: dict[str, str] = {}
    for n in (x.strip() for x in names):
        if n:
            seen.setdefault(n.lower(), n)
    return list(seen.values())
