"""Deterministic row ids from canonical identity columns."""

from __future__ import annotations

import hashlib
import unicodedata
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .normalize import canonical_text

SEPARATOR = "\x1f"


def payload(*columns: Column) -> Column:
    """Texts joined by a unit separator; nulls keep their place as empty texts."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def row_id(*columns: Column) -> Column:
    """An MD5 of the payload, written as a uuid; stays in the JVM.  Pass names through canonical_text."""
    digest = F.md5(payload(*columns))
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def canonical_name(text: str | None) -> str:
    """Composed (NFC), lower case, one space between words; null as empty."""
    return " ".join(unicodedata.normalize("NFC", text or "").split()).lower()


@F.pandas_udf(T.StringType())
def _blake2_uuid(rows: pd.DataFrame) -> pd.Series:
    texts = [["" if v is None or v != v else str(v) for v in rows[c]] for c in rows.columns if not c.startswith("name_")]
    # the name's place among the fields is in its column's name
    for c in rows.columns:
        if c.startswith("name_"):
            texts.insert(int(c[5:]), [canonical_name(v if isinstance(v, str) else None) for v in rows[c]])
    return pd.Series([str(uuid.UUID(bytes=hashlib.blake2b(SEPARATOR.join(p).encode(), digest_size=16).digest())) for p in zip(*texts, strict=True)], dtype="object")


def row_id_parity(*columns: Column, name: int | None = None) -> Column:
    """The id by BLAKE2b-128 with the field at place `name` composed and folded, which the JVM lacks: an Arrow UDF."""
    return _blake2_uuid(F.struct(*[c.cast("string").alias(f"name_{k}" if k == name else f"c{k}") for k, c in enumerate(columns)]))


def partner_id(df: DataFrame, columns: tuple[str, ...], name: str, parity: bool = False) -> Column:
    """Id of a partner row from its identity columns; only the name is folded."""
    if parity:
        return row_id_parity(*[F.col(c) for c in columns], name=columns.index(name))
    return row_id(*[canonical_text(F.col(c)) if c == name else F.col(c) for c in columns])
