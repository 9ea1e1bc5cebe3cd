"""Table contracts: a JSON document declares a table's columns and layout.

A contract is the single source of a table's ``StructType``. Writes go
through :func:`conform` (K11): every declared column must exist, is cast to
its declared type and put in contract order; a NOT NULL column holding NULLs
is refused. :func:`check` (Q5) reports the same facts as a one-row-per-column
DataFrame computed in a single aggregate pass.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contract type names and the Spark types they map to.
TYPE_NAMES = {
    "STRING": T.StringType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BOOLEAN": T.BooleanType(),
    "MAP<STRING,LONG>": T.MapType(T.StringType(), T.LongType()),
}

_TEMPLATE = re.compile(r"\{([a-z_]+)\.([a-z_]+)\}")


def resolve(text: str, config: dict) -> str:
    """Fill ``{section.key}`` placeholders (``{catalog.gold}``, ``{path.landing}``)."""
    def sub(m):
        try:
            return str(config[m.group(1)][m.group(2)])
        except KeyError as exc:
            raise KeyError(f"no config value for {m.group(0)}") from exc
    return _TEMPLATE.sub(sub, text)


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True
    comment: str = ""

    @property
    def spark_type(self) -> T.DataType:
        return TYPE_NAMES[self.type.upper()]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Column, ...]
    schema_name: str = "default"
    catalog: str = "local"
    format: str = "parquet"
    partitions: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    change_data_feed: bool = False
    properties: dict = field(default_factory=dict)

    @property
    def full_name(self) -> str:
        return f"{self.catalog}.{self.schema_name}.{self.name}"

    @property
    def view_name(self) -> str:
        """``catalog_schema_name``: the temp-view name of the table for ``spark.sql``."""
        return f"{self.catalog}_{self.schema_name}_{self.name}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable)
                             for c in self.columns])

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.spark_type.simpleString()}" for c in self.columns)

    @classmethod
    def from_dict(cls, doc: dict, config: dict | None = None) -> "Contract":
        if config:
            doc = json.loads(resolve(json.dumps(doc), config))
        cols = tuple(Column(c["name"], c["type"], c.get("nullable", True), c.get("comment", ""))
                     for c in doc["columns"])
        for c in cols:
            if c.type.upper() not in TYPE_NAMES:
                raise ValueError(f"{doc['name']}.{c.name}: unknown type {c.type}")
        return cls(
            name=doc["name"], columns=cols,
            schema_name=doc.get("schema", "default"), catalog=doc.get("catalog", "local"),
            format=doc.get("format", "parquet"),
            partitions=tuple(doc.get("partitions", ())), keys=tuple(doc.get("keys", ())),
            change_data_feed=bool(doc.get("change_data_feed", False)),
            properties=dict(doc.get("properties", {})),
        )

    @classmethod
    def load(cls, path: str | Path, config: dict | None = None) -> "Contract":
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")), config)


class ContractError(ValueError):
    pass


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    have = set(df.columns)
    return [n for n in contract.names if n not in have]


def conform(df: DataFrame, contract: Contract, check_nulls: bool = True) -> DataFrame:
    """K11 + P4: project to contract order and types, refusing what does not fit.

    Missing and undeclared columns fail at once (driver-side, schema only), and a
    fraction that a whole-number column would cut off fails in the writing task. The NOT NULL rule
    is checked inline: a NULL in a NOT NULL column raises inside the task that
    writes it (``raise_error``), so the check costs no extra pass over the
    data and a failed write leaves no committed version behind.
    """
    missing = missing_columns(df, contract)
    if missing:
        raise ContractError(f"{contract.full_name}: missing columns {missing}")
    extra = [n for n in df.columns if n not in contract.names]
    if extra:
        raise ContractError(f"{contract.full_name}: undeclared columns {extra}")
    out = []
    for c in contract.columns:
        col = F.col(c.name).cast(c.spark_type)
        if isinstance(df.schema[c.name].dataType, T.FractionalType) and isinstance(c.spark_type, T.IntegralType):
            msg = f"{contract.full_name}: {c.name} would lose its fraction"
            col = F.when(F.col(c.name) != F.floor(F.col(c.name)),
                         F.raise_error(F.lit(msg)).cast(c.spark_type)).otherwise(col)
        if check_nulls and not c.nullable:
            msg = f"{contract.full_name}: NULL in NOT NULL column {c.name}"
            col = F.when(col.isNull(), F.raise_error(F.lit(msg)).cast(c.spark_type)).otherwise(col)
        out.append(col.alias(c.name))
    return df.select(out)


def row_fault(df: DataFrame, contract: Contract):
    """Why a row does not fit its contract, as a column, or NULL where it fits: the rules of
    :func:`conform` row by row, for callers that keep such rows aside."""
    missing = missing_columns(df, contract)
    if missing:
        raise ContractError(f"{contract.full_name}: missing columns {missing}")
    faults = [F.lit(None).cast("string")]
    for c in contract.columns:
        col, have = F.col(c.name), df.schema[c.name].dataType
        if not c.nullable:
            faults.append(F.when(col.isNull(), F.lit(f"null {c.name}")))
        if have != c.spark_type:
            faults.append(F.when(col.isNotNull() & col.try_cast(c.spark_type).isNull(),
                                 F.lit(f"{c.name} is no {c.spark_type.simpleString()}")))
        if isinstance(have, T.FractionalType) and isinstance(c.spark_type, T.IntegralType):
            faults.append(F.when(col != F.floor(col), F.lit(f"{c.name} has a fraction")))
    return F.coalesce(*faults)


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """Q5: one row per contract column, from one aggregate pass over ``df``.

    Columns: column, expected_type, actual_type, present, nulls,
    not_null_violations, cast_failures (values present but not castable to
    the contract type), plus one ``_corrupt_record`` row when the frame
    carries that column (unparseable landing lines).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    aggs, meta = [], []
    for i, c in enumerate(contract.columns):
        present = c.name in have
        if present:
            col = F.col(c.name)
            aggs.append(F.count_if(col.isNull()).alias(f"n{i}"))
            aggs.append(F.count_if(col.isNotNull() & col.try_cast(c.spark_type).isNull())
                        .alias(f"f{i}"))
        meta.append((c.name, c.spark_type.simpleString(),
                     have[c.name].simpleString() if present else None, present, c.nullable))
    corrupt = "_corrupt_record" in have
    if corrupt:
        aggs.append(F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt"))
    aggs.append(F.count(F.lit(1)).alias("rows"))
    counts = df.agg(*aggs)
    rows = []
    for i, (name, expected, actual, present, nullable) in enumerate(meta):
        nulls = F.col(f"n{i}") if present else F.col("rows")
        fails = F.col(f"f{i}") if present else F.lit(0).cast("long")
        rows.append(F.struct(
            F.lit(name).alias("column"), F.lit(expected).alias("expected_type"),
            F.lit(actual).cast("string").alias("actual_type"), F.lit(present).alias("present"),
            nulls.cast("long").alias("nulls"),
            (F.lit(0) if nullable else nulls).cast("long").alias("not_null_violations"),
            fails.cast("long").alias("cast_failures")))
    if corrupt:
        rows.append(F.struct(
            F.lit("_corrupt_record").alias("column"), F.lit("string").alias("expected_type"),
            F.lit("string").alias("actual_type"), F.lit(True).alias("present"),
            F.lit(0).cast("long").alias("nulls"), F.lit(0).cast("long").alias("not_null_violations"),
            F.col("corrupt").cast("long").alias("cast_failures")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
