"""P6 on typed columns: object ids become strings in the schema, not in text.

An object id is a struct whose only field is ``$oid``, as a reader of extended
JSON infers it. The rewrite follows the schema and builds one expression per
column: structs field by field, arrays and map values with ``transform``. A
column without an object id stays as it is, so Spark neither copies nor reads
more than before; there is no text, no pattern and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_KEY = "$oid"


def is_id(kind: T.DataType, id_key: str = ID_KEY) -> bool:
    return isinstance(kind, T.StructType) and kind.fieldNames() == [id_key]


def has_ids(kind: T.DataType, id_key: str = ID_KEY) -> bool:
    if is_id(kind, id_key):
        return True
    if isinstance(kind, T.StructType):
        return any(has_ids(f.dataType, id_key) for f in kind)
    if isinstance(kind, T.ArrayType):
        return has_ids(kind.elementType, id_key)
    return isinstance(kind, T.MapType) and has_ids(kind.valueType, id_key)


def plain_ids(c: Column, kind: T.DataType, id_key: str = ID_KEY) -> Column:
    """``c`` of type ``kind`` with every object id inside replaced by its
    string; nulls of any level stay null."""
    if not has_ids(kind, id_key):
        return c
    if is_id(kind, id_key):
        return c.getField(id_key).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: plain_ids(x, kind.elementType, id_key))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: plain_ids(x, kind.valueType, id_key))
    fields = [plain_ids(c.getField(f.name), f.dataType, id_key).alias(f.name) for f in kind]
    return F.when(c.isNotNull(), F.struct(*fields))


def stringify_typed_ids(df: DataFrame, id_key: str = ID_KEY) -> DataFrame:
    """All columns of ``df`` with object ids of any depth as strings.
    Names, order and every other value stay; a struct that has more fields
    than ``$oid`` is no object id, but ids inside it are replaced."""
    return df.select(*[plain_ids(F.col(f"`{f.name}`"), f.dataType, id_key).alias(f.name) for f in df.schema])
