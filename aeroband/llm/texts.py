"""What the operators of this folder share: word rules, column handling and Arrow passes.

Every operator first reduces its input to the columns it names, or packs all columns into one struct, so that extra
columns of any name cannot clash with working columns.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word is a run of anything but space and the control characters 9 to 13, which is also how bytes.split() divides.
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns as one struct."""
    return F.struct(*[col(name) for name in df.columns])


def unpacked(df: DataFrame, name: str, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of the struct ``name``."""
    return df.select(*[F.col(name).getField(field).alias(field) for field in like.columns])


def row_hash(df: DataFrame) -> Column:
    """A number that tells rows apart that share an id."""
    return F.xxhash64(*[col(name) for name in df.columns])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text in lower case; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def add_columns(df: DataFrame, text: str, fields: T.StructType, of_text: Callable[[bytes], tuple]) -> DataFrame:
    """``df`` without ``text``, and ``fields`` that ``of_text`` computes from its UTF-8 bytes (null: empty).

    One Arrow pass without a shuffle; a task holds one batch of texts.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType(kept + fields.fields)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [_arrow_type(f.dataType) for f in fields.fields]
        for batch in batches:
            column = batch.column(text).cast(pa.binary())
            found = [of_text(value.as_py() or b"") for value in column]
            made = [pa.array(values, type=kind) for values, kind in zip(zip(*found), types)] if found else [
                pa.array([], type=kind) for kind in types
            ]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + made, names=schema.names)

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary(),
        T.BooleanType: pa.bool_(), T.DoubleType: pa.float64(),
    }[type(kind)]
