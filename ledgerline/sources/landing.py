"""Landing files: headerless, delimited, Latin-1 CSV by family, with guards and a ledger."""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as N
from ..functions.identity import partner_id
from ..functions.validate import Rule, domain_rule, format_rule, length_rule, required_rule
from ..plans.specs import FAMILIES, NO_DOCUMENT, PARTNER_IDENTITY, UFS, Family

CORRUPT = "_corrupt_record"
#: Bytes of a member that a task holds at a time.
BLOCK = 1 << 20
# Beginnings of archive names.
ARCHIVES = [
    ("SIMPLES", "SIMPLESCSV"), ("CNAE", "CNAECSV"), ("MOTI", "MOTICSV"), ("MUNIC", "MUNICCSV"), ("NATUR", "NATJUCSV"), ("PAIS", "PAISCSV"), ("QUALIFICAC", "QUALSCSV"),
    ("EMPRES", "EMPRECSV"), ("ESTABELE", "ESTABELE"), ("SOCIO", "SOCIOCSV"),
]


class LayoutDriftError(ValueError):
    """Files whose records don't have the expected number of fields."""


def family_of_file(name: Column) -> Column:
    """Family of a file name by what it contains; SIMPLES comes first; unknown names are null."""
    upper = F.upper(name)
    out = F.when(upper.contains("SIMPLES"), "SIMPLESCSV")
    for family in FAMILIES:
        out = out.when(upper.contains(family), family)
    return out


def family_of_archive(name: Column) -> Column:
    upper = F.upper(name)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for prefix, family in ARCHIVES:
        out = out.when(upper.startswith(prefix), family)
    return out


#: How landing files are read.
OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "encoding": "ISO-8859-1", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}


def raw_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])


def read_strings(spark: SparkSession, path: str | list[str], columns: tuple[str, ...]) -> DataFrame:
    """All fields as strings, by position; empty ones are null; records of another width carry their raw line.

    Column pruning is off, else a reader that skips fields misses wrong widths.
    """
    return tidy_strings(spark.read.schema(raw_schema(columns)).options(**OPTIONS).csv(path), columns)


def tidy_strings(read: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Records as they were read, with the file's name and null for empty fields.

    The raw line goes with a data column, as Spark refuses to read it alone.
    """
    rows = read.withColumn("file_name", F.col("_metadata.file_name"))
    there = F.length(F.coalesce(F.col(columns[0]), F.lit(""))) >= 0
    return rows.withColumn(CORRUPT, F.when(there, F.col(CORRUPT))).withColumns({c: N.empty_to_null(F.col(c)) for c in columns})


def read_landing(spark: SparkSession, path: str | list[str], family: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and quarantined ones as (file_name, raw)."""
    columns = FAMILIES[family].columns
    rows = read_strings(spark, path, columns)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.where(F.col(CORRUPT).isNotNull()).select("file_name", F.col(CORRUPT).alias("raw"))


def width_report(rows: DataFrame) -> DataFrame:
    """(file_name, n_rows, n_bad) of rows from read_strings."""
    return rows.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("n_bad"))


def check_layout(rows: DataFrame, first_record_only: bool = False) -> None:
    """Raises where a file has wrong records, or a wrong first one; empty files pass."""
    if first_record_only:
        place = rows.select("file_name", CORRUPT, F.monotonically_increasing_id().alias("_at"))
        heads = place.groupBy("file_name").agg(F.min_by(F.col(CORRUPT).isNotNull(), "_at").alias("bad"))
        bad = heads.where("bad").select("file_name", F.lit(1).alias("n_bad"))
    else:
        bad = width_report(rows).where("n_bad > 0").select("file_name", "n_bad")
    found = bad.orderBy("file_name").limit(20).collect()
    if found:
        raise LayoutDriftError(", ".join(f"{r['file_name']}: {r['n_bad']} records" for r in found))


def normalise(df: DataFrame, family: str, pad_partner_country: bool = False) -> DataFrame:
    """Locale numbers, placeholder dates, padding, missing documents and the partner's id; strings stay strings."""
    spec = FAMILIES[family]
    out = df.withColumns({c: N.strip_nul(F.col(c)) for c in spec.columns})
    changes: dict[str, Column] = {c: N.negative_to_null(N.locale_decimal(F.col(c))) for c in spec.doubles}
    changes |= {c: N.placeholder_date_to_null(F.col(c)) for c in spec.dates}
    if family == "ESTABELE":
        changes |= {"pais": N.pad_code(F.col("pais"), 3), "cep": N.pad_exact(F.col("cep"), 7, 8)}
    if family == "SOCIOCSV":
        changes["cnpj_cpf_do_socio"] = N.backfill(F.col("cnpj_cpf_do_socio"), NO_DOCUMENT)
        if pad_partner_country:
            changes["pais"] = N.pad_code(F.col("pais"), 3)
    return out.withColumns(changes) if changes else out


def identified(df: DataFrame, family: str, parity: bool = False) -> DataFrame:
    """Adds socio_id, first in order, to partner rows; others keep their columns."""
    if family != "SOCIOCSV":
        return df
    return df.withColumn("socio_id", partner_id(df, PARTNER_IDENTITY, "nome_socio", parity)).select("socio_id", *df.columns)


def clean_dates(df: DataFrame, family: str, as_of: str) -> DataFrame:
    """Dates that don't exist, are before 1900 or after `as_of` become null; strings stay strings.

    Strings of eight digits have the order of their dates, so each is read as a date once.
    """
    inside = lambda c: c.between(F.lit("19000101"), F.lit(as_of.replace("-", "")))
    return df.withColumns({c: F.when(inside(F.col(c)) & N.to_date_or_null(F.col(c)).isNotNull(), F.col(c)) for c in FAMILIES[family].dates})


def typed(df: DataFrame, family: str) -> DataFrame:
    spec = FAMILIES[family]
    casts = {c: N.to_date_or_null(F.col(c)) for c in spec.dates} | {c: N.to_double_or_null(F.col(c)) for c in spec.doubles} | {c: N.to_int_or_null(F.col(c)) for c in spec.integers}
    return df.withColumns(casts) if casts else df


def family_rules(family: str, as_of: str) -> list[Rule]:
    """Formats, states, dates, lengths and required columns of a family's normalised rows."""
    spec = FAMILIES[family]
    rules = [format_rule(c, p) for c, p in spec.rules.items()]
    if "uf" in spec.columns:
        rules.append(domain_rule("uf", UFS))
    for c in spec.dates:
        date = N.to_date_or_null(F.col(c))
        rules.append((f"{c}:calendar", F.col(c).isNotNull(), F.col(c).isNotNull() & date.isNull()))
        rules.append((f"{c}:range", date.isNotNull(), date.isNotNull() & N.date_in_range(date, as_of).isNull()))
    return rules + [length_rule(c, n) for c, n in spec.lengths.items()] + [required_rule(c) for c in spec.required]


def load(spark: SparkSession, path: str | list[str], family: str, as_of: str, cast: bool = True, parity: bool = False) -> DataFrame:
    """From landing files to a table's rows, in its column order."""
    spec: Family = FAMILIES[family]
    rows, _ = read_landing(spark, path, family)
    rows = clean_dates(identified(normalise(rows.select(*spec.columns), family), family, parity), family, as_of)
    return typed(rows, family) if cast else rows


def latest_delivery(deliveries: DataFrame, wanted: str | None = None) -> str:
    """The greatest YYYY-MM of a column source_month, or the wanted one if it is there."""
    months = deliveries.select("source_month").where(F.col("source_month").rlike(r"^[0-9]{4}-[0-9]{2}\z"))
    month = months.agg(F.max("source_month")).first()[0] if wanted is None else (wanted if months.where(F.col("source_month") == wanted).limit(1).count() else None)
    if month is None:
        raise ValueError(f"no delivery {wanted or ''}".strip())
    return month


def write_delivery(df: DataFrame, path: str, month: str) -> None:
    """Puts a month's rows into a table that is partitioned by source_month; that month's rows are replaced, no other's."""
    rows = df.withColumn("source_month", F.lit(month))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("source_month").parquet(path)


LEDGER_KEY = ["directory", "filename"]


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    return files.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")


def ledger_append(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """The ledger with files that it lacks, each once."""
    fresh = pending_files(files.select(*LEDGER_KEY).distinct(), ledger).withColumn("processed_at", F.current_timestamp())
    return ledger.unionByName(fresh, allowMissingColumns=True)


def force_reprocess(ledger: DataFrame, directory: str) -> DataFrame:
    return ledger.where(F.col("directory") != directory)


def archive_members(paths: DataFrame) -> DataFrame:
    """(archive, member, bytes) of the members of known families; only the archives' directories are read."""
    patterns = ("SIMPLES", *FAMILIES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        for path in (path for batch in batches for path in batch["path"]):
            own, place = FileSystem.from_uri(path)
            with own.open_input_file(place) as opened, zipfile.ZipFile(opened) as archive:
                found = [(path, m.filename, m.file_size) for m in archive.infolist() if any(p in m.filename.upper() for p in patterns)]
            yield pd.DataFrame(found, columns=["archive", "member", "bytes"])

    return paths.select("path").mapInPandas(run, "archive string, member string, bytes long")


def extract_archives(paths: DataFrame, target: str) -> DataFrame:
    """(archive, member, file, bytes, crc_ok) of each wanted member, written under `target`, a folder that all tasks share.

    One row of `paths` (column path) is one archive, and each member is a task of its
    own, as a compressed stream can't be read from its middle.  Paths and target may be plain
    or of any store that Arrow opens (file, hdfs, s3, gs). Members stream through a
    fixed buffer into a folder of their archive, so equal names in two archives don't
    meet; a file gets its name when it is whole. Members of no known family are left
    out; a broken member has a null file.
    """
    schema = "archive string, member string, file string, bytes long, crc_ok boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow.fs import FileSystem

        store, base = FileSystem.from_uri(target)
        for path, member in (pair for batch in batches for pair in zip(batch["archive"], batch["member"], strict=True)):
            own, place = FileSystem.from_uri(path)
            folder = f"{place.rsplit('/', 1)[-1].rsplit('.', 1)[0]}-{zlib.crc32(path.encode()):08x}"
            store.create_dir(f"{base}/{folder}")
            name = "_".join(p for p in member.split("/") if p not in ("", ".", ".."))
            size, ok, part = 0, True, f"{base}/{folder}/_{uuid.uuid4().hex}"  # scans pass over such names
            with own.open_input_file(place) as opened, zipfile.ZipFile(opened) as archive:
                try:
                    with archive.open(member) as source, store.open_output_stream(part) as sink:
                        while block := source.read(BLOCK):
                            size += sink.write(block)
                    store.move(part, f"{base}/{folder}/{name}")
                except (zipfile.BadZipFile, zlib.error):
                    ok = False
                    store.delete_file(part)
            file = f"{target.rstrip('/')}/{folder}/{name}" if ok else None
            yield pd.DataFrame([(path, member, file, size, ok)], columns=["archive", "member", "file", "bytes", "crc_ok"])

    members = archive_members(paths)
    many = members.count()
    return members.repartition(max(1, min(many, 10_000))).mapInPandas(run, schema) if many else paths.sparkSession.createDataFrame([], schema)
