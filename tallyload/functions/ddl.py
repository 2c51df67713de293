"""Registry column lists: Spark DDL with a few vendor type words mapped first.

The registry stores, per event type, an ordered column list such as
``id bigint not null, name varchar(20), ts datetime``.  Data files carry no
header, so the order is the file's field order.  Spark's own DDL reader does
the parsing; ``varchar(n)``/``char(n)`` and ``not null`` survive it and become
row rules (B8) instead of hard errors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Vendor type words accepted in registry column lists and their
# Spark DDL equivalents (matched at the start of a column's type, case-insensitive).
TYPE_ALIASES = [
    (r"unsigned\s+int\b", "bigint"),
    (r"datetime\b", "timestamp"),
    (r"tinyint\b", "smallint"),
    (r"varchar2\b", "varchar"),
    (r"number\s*\(", "decimal("),
    (r"number\b", "decimal(38,10)"),
    (r"string\s*\(\s*(\d+)\s*\)", r"varchar(\1)"),
]
_COLUMN = re.compile(r"^\s*(`[^`]+`|[^\s:]+)\s*:?\s*(.*)$", re.DOTALL)
# a type: a name, or unsigned int, with optional arguments in parentheses or angle brackets
_TYPE = re.compile(r"^((?:unsigned\s+)?[A-Za-z_]\w*\s*(?:\([^)]*\)|<.*>)?)(.*)$", re.DOTALL)

CORRUPT_COLUMN = "_corrupt_record"
# the record as it stands in the file
RAW_COLUMN = "_raw"


def split_columns(columns: str) -> list[str]:
    """The column declarations of a list: cut at commas outside parentheses, brackets and quotes."""
    out, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(columns):
        if quote:
            quote = "" if c == quote else quote
        elif c in "`'":
            quote = c
        elif c in "(<":
            depth += 1
        elif c in ")>":
            depth -= 1
        elif c == "," and depth == 0:
            out.append(columns[start:i])
            start = i + 1
    return out + [columns[start:]]


def to_spark_ddl(columns: str) -> str:
    """Spark DDL of a column list: names stay as they are, type words are mapped in type position only,
    and of the text after the type (``unique (255)``, ``null``, ``default 0``, ...) only ``not null`` stays."""
    out = []
    for column in split_columns(columns):
        named = _COLUMN.match(column)
        typed = _TYPE.match(named[2]) if named else None
        if not typed:
            out.append(column)  # Spark's own parser reports what is wrong
            continue
        dtype = typed[1].strip()
        for pat, rep in TYPE_ALIASES:
            dtype = re.sub("^" + pat, rep, dtype, flags=re.IGNORECASE)
        name = named[1] if named[1].startswith("`") else f"`{named[1]}`"
        required = re.search(r"\bnot\s+null\b", typed[2], re.IGNORECASE)
        out.append(f"{name} {dtype}" + (" not null" if required else ""))
    return ", ".join(out)


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str  # "not_null" or "max_length"
    limit: int | None = None


@dataclass(frozen=True)
class DeclaredSchema:
    declared: T.StructType  # as written, with varchar/char and nullability
    read: T.StructType  # what the CSV reader gets: plain strings, all nullable
    rules: tuple[Rule, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.read.fields]

    def read_with_corrupt(self) -> T.StructType:
        return T.StructType(list(self.read.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def declared_schema(columns: str) -> DeclaredSchema:
    declared = T.StructType.fromDDL(to_spark_ddl(columns))
    read_fields, rules = [], []
    for f in declared.fields:
        dt = f.dataType
        if isinstance(dt, (T.VarcharType, T.CharType)):
            rules.append(Rule(f.name, "max_length", dt.length))
            dt = T.StringType()
        if not f.nullable:
            rules.append(Rule(f.name, "not_null"))
        read_fields.append(T.StructField(f.name, dt, True))
    return DeclaredSchema(declared, T.StructType(read_fields), tuple(rules))
