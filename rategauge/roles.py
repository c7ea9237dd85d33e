"""Which column of a table plays which part.

Every operator in this package takes a :class:`Roles`, so the same code runs on
a listings file, on order lines or on an event log.  Operators keep the source
column names in their output; only derived columns have fixed names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Roles:
    """``ids`` identify a record; the other three name one column each."""

    ids: tuple[str, ...]
    group: str
    price: str
    date: str

    def __post_init__(self) -> None:
        object.__setattr__(self, "ids", tuple(self.ids))
        if not self.ids:
            raise ValueError("at least one id column is needed")
        names = self.columns
        if len(set(names)) != len(names):
            raise ValueError(f"a column may play only one role: {names}")

    @property
    def columns(self) -> list[str]:
        return [*self.ids, self.group, self.price, self.date]

    def project(self, df: DataFrame) -> DataFrame:
        """Keep the role columns only, so the scan reads nothing else."""
        return df.select(*self.columns)

    def rename(self, df: DataFrame, target: Roles) -> DataFrame:
        """Keep the role columns and give them the names ``target`` uses."""
        if len(self.ids) != len(target.ids):
            raise ValueError("both mappings need the same number of id columns")
        return df.select(
            *(F.col(mine).alias(theirs) for mine, theirs in zip(self.columns, target.columns))
        )


LISTING = Roles(
    ids=("id",), group="neighbourhood_cleansed", price="price", date="last_scraped"
)
