"""Functions for arrays, maps, JSON and records within records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import _col


def _member(name: str):
    return lambda r: r[name]


def list_join(c: Column | str, sep: str = "|", replacement: str | None = "%7C") -> Column:
    """Stripped items joined by sep. A separator within an item is replaced, or an error if replacement is None."""
    c = _col(c).cast("array<string>")
    if replacement is None:
        bad = F.exists(c, lambda x: x.contains(sep))
        c = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"an item holds the separator {sep}"))).otherwise(c)
    else:
        c = F.transform(c, lambda x: F.replace(x, F.lit(sep), F.lit(replacement)))
    return F.array_join(F.transform(c, lambda x: F.trim(x)), sep, "None")


def list_join_plain(c: Column | str) -> Column:
    """Items joined without a separator."""
    return F.array_join(_col(c).cast("array<string>"), "")


def empty_list_to_null(c: Column | str) -> Column:
    """Null for a list whose items are all null or empty."""
    c = _col(c)
    return F.when(F.size(F.filter(c, lambda x: x.isNotNull() & (x.cast("string") != ""))) > 0, c)


def columns_of(records: Column, kind: T.StructType) -> dict[str, Column]:
    """A list of records as one list for each field; absent members are null."""
    return {f.name: F.transform(records, _member(f.name)) for f in kind.fields}


def flatten_records(df: DataFrame, separator: str = "__") -> DataFrame:
    """Records become columns parent__child, lists of records lists parent__child; lists within those are left out."""
    out: list[Column] = []

    def walk(name: str, c: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{name}{separator}{f.name}", c[f.name], f.dataType)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for f in kind.elementType.fields:
                lift(f"{name}{separator}{f.name}", F.transform(c, _member(f.name)), f.dataType)
        else:
            out.append(c.alias(clean_name(name)))

    def lift(name: str, c: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                lift(f"{name}{separator}{f.name}", F.transform(c, _member(f.name)), f.dataType)
        elif not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
            out.append(c.alias(clean_name(name)))

    for f in df.schema.fields:
        walk(f.name, F.col(f"`{f.name}`"), f.dataType)
    return df.select(*out)


def clean_name(name: str, dot: str = "__") -> str:
    return name.replace(".", dot).replace("-", "_")


def drop_records(df: DataFrame) -> DataFrame:
    """Without columns that hold records."""
    return df.drop(*(f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)))


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """The columns of a schema in its order, missing ones null; and the names that the schema doesn't know."""
    have = set(df.columns)
    picked = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*picked), sorted(have - {f.name for f in schema.fields})


def object_keys(c: Column | str) -> Column:
    return F.json_object_keys(_col(c))


def json_truth(c: Column | str, name: str) -> Column:
    """Whether a JSON object has a number other than 0 by a name."""
    return F.coalesce(F.get_json_object(_col(c), f"$.{name}").try_cast("double") != 0, F.lit(False))


def year_columns(df: DataFrame, prefix: str = "date__", suffix: str = "__year") -> DataFrame:
    """A year column for each date column."""
    return df.withColumns({f"{c}{suffix}": F.date_format(F.to_timestamp(c), "yyyy") for c in df.columns if c.startswith(prefix) and not c.endswith(suffix)})


def in_dates(c: Column | str, start: str, end: str) -> Column:
    """Whether a timestamp's UTC date lies between two dates, both included."""
    return F.to_date(F.to_timestamp(_col(c))).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def now() -> Column:
    """UTC now, rounded to seconds, as an ISO string."""
    return F.date_format(F.date_trunc("second", F.current_timestamp() + F.expr("interval 500 milliseconds")), "yyyy-MM-dd'T'HH:mm:ssXXX")
