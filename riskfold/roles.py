"""Column roles (id, label, categorical, numeric) derived from a schema.

Roles are a driver-side schema walk: no Spark job runs here.  They are
recomputed after every schema change so that a dropped column never
reappears in a later stage.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The default column names of the credit-statement data set.
DEFAULT_ID_COLS = ("customer_ID", "date", "test")
DEFAULT_LABEL_COL = "target"
DEFAULT_CATEGORICAL_COLS = (
    "B_30", "B_38", "D_114", "D_116", "D_117", "D_120",
    "D_126", "D_63", "D_64", "D_66", "D_68",
)

# int, bigint, float, double, smallint, tinyint; decimal is not a feature type.
NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
)
FLOATING_TYPES = (T.FloatType, T.DoubleType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def is_floating_type(dt: T.DataType) -> bool:
    return isinstance(dt, FLOATING_TYPES)


@dataclass(frozen=True)
class Roles:
    """Column roles of one table.

    ``numeric`` holds feature columns with an int or floating type;
    ``categorical`` holds the listed categorical columns that exist.
    Columns with any other type and no role are carried, never used.
    """

    id_cols: tuple[str, ...]
    label_col: str | None
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    floating: frozenset[str] = frozenset()
    types: tuple[tuple[str, str], ...] = ()  # each feature's type name

    @classmethod
    def from_schema(
        cls,
        schema: T.StructType,
        id_cols=DEFAULT_ID_COLS,
        label_col: str | None = DEFAULT_LABEL_COL,
        categorical=DEFAULT_CATEGORICAL_COLS,
    ) -> "Roles":
        names = [f.name for f in schema.fields]
        ids = tuple(c for c in id_cols if c in names)
        label = label_col if label_col in names else None
        cats = tuple(c for c in categorical if c in names)
        reserved = set(ids) | set(cats) | ({label} if label else set())
        numeric = tuple(
            f.name for f in schema.fields
            if f.name not in reserved and is_numeric_type(f.dataType)
        )
        floating = frozenset(
            f.name for f in schema.fields
            if f.name in numeric and is_floating_type(f.dataType)
        )
        types = tuple((f.name, f.dataType.simpleString()) for f in schema.fields if f.name in numeric or f.name in cats)
        return cls(ids, label, cats, numeric, floating, types)

    @classmethod
    def of(cls, df: DataFrame, **kwargs) -> "Roles":
        return cls.from_schema(df.schema, **kwargs)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def refresh(self, schema: T.StructType) -> "Roles":
        """Keep only the columns still present in ``schema``."""
        names = set(schema.fieldNames())
        return replace(
            self,
            id_cols=tuple(c for c in self.id_cols if c in names),
            label_col=self.label_col if self.label_col in names else None,
            categorical=tuple(c for c in self.categorical if c in names),
            numeric=tuple(c for c in self.numeric if c in names),
            floating=frozenset(c for c in self.floating if c in names),
            types=tuple((c, t) for c, t in self.types if c in names),
        )

    def type_of(self, name: str) -> str | None:
        return dict(self.types).get(name)

    def role_of(self, name: str) -> str:
        if name in self.id_cols:
            return "id"
        if name == self.label_col:
            return "label"
        if name in self.categorical:
            return "categorical"
        if name in self.numeric:
            return "numeric"
        return "other"


def schema_report(spark: SparkSession, df: DataFrame, roles: Roles) -> DataFrame:
    """One row per column: position, name, Spark type and role.

    Built from the schema on the driver; its size is the column count.
    """
    rows = [
        (i, f.name, f.dataType.simpleString(), roles.role_of(f.name))
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "position int, column_name string, dtype string, role string"
    )
