"""The table of models: what there is by kind and name, what it can be told, and which columns it gives."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Model:
    """One row of the table. ``output`` are columns in DDL that the transform's result has, ``options`` the defaults."""

    kind: str
    name: str
    output: str
    options: dict
    build: Callable[..., Transform]

    def ready(self, given: dict) -> Transform:
        """The transform for these options, its result checked against ``output``."""
        if strange := sorted(given.keys() - self.options.keys()):
            raise ValueError(f"{self.kind} {self.name} has no option {', '.join(strange)}; it has {', '.join(self.options) or 'none'}")
        needed = [k for k, v in (self.options | given).items() if v is ...]
        if needed:
            raise ValueError(f"{self.kind} {self.name} needs {', '.join(needed)}")
        transform = self.build(**(self.options | given))
        promised = {f.name: f.dataType for f in StructType.fromDDL(self.output)}

        def run(rows: DataFrame) -> DataFrame:
            out = transform(rows)
            got = {f.name: f.dataType for f in out.schema}
            if wrong := [n for n, t in promised.items() if got.get(n) != t]:
                raise TypeError(f"{self.kind} {self.name} gives no proper {', '.join(wrong)}")
            return out

        return run


TABLE: dict[tuple[str, str], Model] = {}


def provides(kind: str, name: str, output: str, /, **options):
    """Adds the decorated builder to the table; an option whose default is ``...`` has to be given."""

    def add(build: Callable[..., Transform]):
        row = TABLE.setdefault((kind, name), Model(kind, name, output, options, build))
        if row.build is not build:
            raise ValueError(f"two models for {kind} {name}")
        return build

    return add


def model(kind: str, name: str, /, **options) -> Transform:
    """The transform of that name."""
    if row := TABLE.get((kind, name)):
        return row.ready(options)
    raise LookupError(f"{kind} is one of {', '.join(by_kind().get(kind, ['nothing']))}, not {name}")


def by_kind() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for kind, name in sorted(TABLE):
        out.setdefault(kind, []).append(name)
    return out
