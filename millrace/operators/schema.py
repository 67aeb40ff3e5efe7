"""Projection operators: header renames, conforming to a target schema, lineage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.clean import CENTURY_FROM, CLEANERS, STORED_TYPES, clean_date, clean_text
from millrace.functions.names import kind_by_keyword, match_column, snake_case

LINEAGE = ("file_path", "created_at", "updated_at")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rename_all(df: DataFrame, rule: Callable[[str], str] = snake_case) -> DataFrame:
    """All headers through one rule. A name that comes out again gets a number: no column is lost."""
    taken: dict[str, str] = {}
    for raw in df.columns:
        name, n = rule(raw), 1
        while name in taken:
            n += 1
            name = f"{rule(raw)}.{n}"
        taken[name] = raw
    return df.select([F.col(quoted(raw)).alias(name) for name, raw in taken.items()])


def drop_serial(df: DataFrame) -> DataFrame:
    return df.drop("sl_no")


def source_of(target: str, headers: list[str]) -> str | None:
    """The input column for a target column: the same name, else the same letters without underscores."""
    if target in headers:
        return target
    bare = target.replace("_", "")
    return next((h for h in headers if h.replace("_", "") == bare), None)


def cleaned(name: str, kind: str, century_from: int) -> Column:
    text = F.col(quoted(name)).cast("string")
    return clean_date(text, century_from) if kind == "date" else CLEANERS[kind](text)


def with_bad_cells(df: DataFrame, raw: dict[str, Column], bad: str | None, names: list[str]) -> DataFrame:
    """``df`` of cleaned columns, with ``bad``: the names of those whose input text is not blank and yet gave NULL.

    The input text of typed columns stands beside them for one projection, so that no cell is cleaned twice.
    """
    shown = [F.col(quoted(n)) for n in names]
    if bad is None:
        return df.select(shown)
    lost = {n: F.col(quoted(n)).isNull() & clean_text(text).isNotNull() for n, text in raw.items()}
    found = F.array().cast("array<string>")
    if lost:
        # Most rows lose nothing, and have no list made for them.
        listed = F.array_compact(F.array(*[F.when(bad_cell, F.lit(n)) for n, bad_cell in lost.items()]))
        found = F.when(reduce(or_, lost.values()), listed).otherwise(found)
    return df.select(*shown, found.alias(bad))


def _raw(n: str) -> str:
    return f"_raw_{n}"


def _typed(kinds: dict[str, str], sources: dict[str, str | None]) -> dict[str, str]:
    return {n: sources[n] for n, k in kinds.items() if sources.get(n) is not None and k not in ("string", "text", "flag")}


def absent_cells(columns: list[str], kinds: dict[str, str], keep: tuple[str, ...], dynamic: bool) -> dict[str, Column]:
    """What ``conform``, or ``conform_dynamic``, puts in place of the columns that the input lacks."""
    headers = [c for c in columns if c not in keep]
    found = {n: match_column(n, headers) if dynamic else source_of(n, columns) for n in kinds}
    flag = F.lit(None).cast("string") if dynamic else F.lit("N")
    return {n: flag if k == "flag" else F.lit(None).cast(STORED_TYPES[k]) for n, k in kinds.items() if found[n] is None}


def conform(
    df: DataFrame,
    kinds: dict[str, str],
    keep: tuple[str, ...] = (),
    century_from: int = CENTURY_FROM,
    bad: str | None = None,
) -> DataFrame:
    """One projection onto the target list; absent columns are typed NULLs. ``bad`` names a column for
    the list of cells that could not be read."""

    def cell(name: str, kind: str) -> Column:
        found = source_of(name, df.columns)
        if found is None:
            absent = F.lit("N") if kind == "flag" else F.lit(None).cast(STORED_TYPES[kind])
            return absent.alias(name)
        return cleaned(found, kind, century_from).alias(name)

    cells = [cell(n, k) for n, k in kinds.items()] + [F.col(c) for c in keep]
    typed = _typed(kinds, {n: source_of(n, df.columns) for n in kinds}) if bad is not None else {}
    beside = [F.col(quoted(s)).cast("string").alias(_raw(n)) for n, s in typed.items()]
    return with_bad_cells(df.select(*cells, *beside), {n: F.col(quoted(_raw(n))) for n in typed}, bad, [*kinds, *keep])


def dynamic_kinds(target: StructType, **words) -> dict[str, str]:
    """Column kinds of a target known only by its catalog schema: no id, no lineage, type by keyword."""
    return {
        name: kind_by_keyword(name, **words)
        for name in target.fieldNames()
        if name != "id" and name not in LINEAGE
    }


def conform_dynamic(
    df: DataFrame,
    kinds: dict[str, str],
    keep: tuple[str, ...] = (),
    century_from: int = CENTURY_FROM,
    bad: str | None = None,
) -> DataFrame:
    """Like ``conform``, but input columns are found by exact or containing name."""
    headers = [c for c in df.columns if c not in keep]
    mapping = {name: match_column(name, headers) for name in kinds}
    cells = [
        cleaned(mapping[name], kind, century_from).alias(name)
        if mapping[name] is not None
        else F.lit(None).cast(STORED_TYPES[kind]).alias(name)
        for name, kind in kinds.items()
    ]
    typed = _typed(kinds, mapping) if bad is not None else {}
    beside = [F.col(quoted(s)).cast("string").alias(_raw(n)) for n, s in typed.items()]
    shown = df.select(*cells, *[F.col(c) for c in keep], *beside)
    return with_bad_cells(shown, {n: F.col(quoted(_raw(n))) for n in typed}, bad, [*kinds, *keep])


def add_lineage(df: DataFrame, run_ts: str, file_path: Column | None = None) -> DataFrame:
    """Source file and the two timestamps of the run."""
    path = F.col("_metadata.file_path") if file_path is None else file_path
    now = F.lit(run_ts).cast("timestamp")
    return df.select(
        "*", path.alias("file_path"), now.alias("created_at"), now.alias("updated_at")
    )


def narrow_floats(df: DataFrame) -> DataFrame:
    """Doubles as 32-bit floats; the lost precision shows."""
    return df.select(
        [F.col(quoted(n)).cast("float").alias(n) if t == "double" else F.col(quoted(n)) for n, t in df.dtypes]
    )
