"""Column-level operators: rename, fill, order, stamp."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; other columns stay as they are."""
    return df.withColumnsRenamed(dict(names))


def _by_name(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def add_missing_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Null columns for the target fields that ``df`` lacks."""
    have = _by_name(df)
    missing = {
        f.name: F.lit(None).cast(f.dataType)
        for f in target
        if f.name.lower() not in have
    }
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, matched by name in any case, cast, in order."""
    full = add_missing_columns(df, target)
    have = _by_name(full)
    return full.select(
        *[
            F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def stamp(
    df: DataFrame,
    batch_id: str,
    source_system: str,
    run_ts: Column,
    source_file: Column | None = None,
    reseller: Column | None = None,
) -> DataFrame:
    """Load metadata; a file feed also gets its file, reseller and change time.

    ``run_ts`` is one value for the whole run, so a retried task writes what
    the first attempt wrote.
    """
    columns = {
        "batch_id": F.lit(batch_id),
        "load_ts": run_ts.cast("timestamp_ntz"),
        "source_system": F.lit(source_system),
    }
    if source_file is not None:
        columns["source_file_name"] = source_file
        columns["updated_at"] = run_ts.cast("timestamp_ntz")
    if reseller is not None:
        columns["reseller_id"] = reseller
    return df.withColumns(columns)


def stamp_file(
    df: DataFrame, file_name: Column, file_sha: Column, run_ts: Column
) -> DataFrame:
    """The file, its content hash and the load time: the short form of a file stamp."""
    return df.withColumns(
        {
            "file_name": file_name,
            "file_sha": file_sha,
            "loaded_at": run_ts.cast("timestamp_ntz"),
        }
    )


def coerce_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns as timestamps, unparseable text as null, absent ones ignored."""
    wanted = {c.lower() for c in columns}
    return df.withColumns(
        {
            c: F.col(f"`{c}`").try_cast("timestamp_ntz")
            for c in df.columns
            if c.lower() in wanted
        }
    )
