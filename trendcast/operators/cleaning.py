"""Cleaning of event tables: names, duplicates, types, flags, period bounds, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trendcast.functions.coerce import DAY_FIRST, finite, to_date, to_flag, to_number, to_period_int

# The valid range of years.
MIN_YEAR, MAX_YEAR = 1970, 2035


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the table has, in the order given."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def standardise_names(df: DataFrame) -> DataFrame:
    names = [c.strip().lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after trimming and lower-casing: {', '.join(twice)}")
    return df.toDF(*names)


def keep_first(df: DataFrame, id_col: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per id: the first by ``order_by``, NULL ids counting as one id.

    A narrow count finds the ids that occur more than once; rows of all other
    ids pass as they are. Of the repeated ones an aggregate keeps one candidate
    per id in every map task, so an id that holds a large part of the table
    never meets in one reducer as a whole, which a ``row_number`` window would
    force. Without ``order_by``, and among equals, the smallest row wins, map
    columns aside, which is stable but not the file order. A table without the
    id column loses rows that repeat in every column.
    """
    if id_col not in df.columns:
        return df.dropDuplicates()
    plain = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    repeated = df.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__id")
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    rank = F.struct(*[F.col(c) for c in order_by], *[F.col(c).alias(f"__c{i}") for i, c in enumerate(plain)])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.join(repeated, same, "left_semi").groupBy(F.col(id_col).alias("__id")).agg(F.min_by(row, rank).alias("__row"))
    return df.join(repeated, same, "left_anti").unionByName(best.select("__row.*"))


def convert_types(
    df: DataFrame,
    date_cols: Sequence[str],
    period_col: str = "year",
    formats: Sequence[str] = DAY_FIRST,
) -> DataFrame:
    """Parse dates by the given formats and the period column as a number; bad values are NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {c: to_date(F.col(c), types[c], formats) for c in present(df, date_cols)}
    if period_col in types:
        changes[period_col] = to_number(F.col(period_col), types[period_col])
    return df.withColumns(changes) if changes else df


def date_format_tally(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """How well each format reads each text column: (column_name, format, n_values, n_parsed, n_only, chosen).

    ``n_values`` counts texts that are not null or blank, ``n_parsed`` those that the format reads, ``n_only`` those
    that no other listed format reads. Chosen is the format that reads most, then the one with most of its own, then
    the one listed first; none where no text is read. One pass over the table with partial sums, one row at the end.
    """
    def tallies(column: str) -> list[Column]:
        text = F.trim(F.col(f"`{column}`").cast("string"))
        fits = [F.try_to_date(text, f).isNotNull().cast("long") for f in formats]
        n_fits = sum(fits, F.lit(0))
        return [F.struct(
            F.lit(column).alias("column_name"), F.lit(i).alias("place"), F.lit(f).alias("format"),
            F.coalesce(F.sum((text != "").cast("long")), F.lit(0)).alias("n_values"),
            F.coalesce(F.sum(fits[i]), F.lit(0)).alias("n_parsed"),
            F.coalesce(F.sum(F.when(n_fits == 1, fits[i])), F.lit(0)).alias("n_only"),
        ) for i, f in enumerate(formats)]

    def ranked(of_column: Column) -> Column:
        best = F.array_max(F.transform(of_column, lambda t: F.struct(t["n_parsed"], t["n_only"], -t["place"])))
        return F.transform(of_column, lambda t: F.struct(
            t["column_name"], t["format"], t["n_values"], t["n_parsed"], t["n_only"],
            ((t["n_parsed"] > 0) & (F.struct(t["n_parsed"], t["n_only"], -t["place"]) == best)).alias("chosen")))

    have = present(df, columns)
    totals = df.agg(*[F.array(*tallies(c)).alias(f"t{i}") for i, c in enumerate(have)])
    return totals.select(F.inline(F.flatten(F.array(*[ranked(F.col(f"t{i}")) for i in range(len(have))])))).toDF(
        "column_name", "format", "n_values", "n_parsed", "n_only", "chosen")


def chosen_formats(tally: DataFrame) -> dict[str, str]:
    """Column → its chosen format, for ``convert_types`` column by column. As small as the list of columns."""
    return {r["column_name"]: r["format"] for r in tally.where("chosen").collect()}


def coerce_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {c: to_flag(F.col(c), types[c]) for c in present(df, flags)}
    return df.withColumns(changes) if changes else df


def valid_periods(
    df: DataFrame, period_col: str = "year", low: int = MIN_YEAR, high: int = MAX_YEAR
) -> DataFrame:
    """Whole periods within [low, high]; rows without a period are dropped."""
    if period_col not in df.columns:
        return df
    whole = to_period_int(F.col(period_col), df.schema[period_col].dataType)
    return df.withColumn(period_col, whole).filter(F.col(period_col).between(low, high))


def clean_events(
    df: DataFrame,
    flags: Sequence[str],
    id_col: str,
    order_by: Sequence[str] = (),
    date_cols: Sequence[str] = (),
    period_col: str = "year",
    formats: Sequence[str] = DAY_FIRST,
    low: int = MIN_YEAR,
    high: int = MAX_YEAR,
) -> DataFrame:
    """The cleaning chain. Duplicates go first, so a bad first copy hides a good second one."""
    return (
        df.transform(standardise_names)
        .transform(keep_first, id_col, order_by)
        .transform(convert_types, date_cols, period_col, formats)
        .transform(coerce_flags, flags)
        .transform(valid_periods, period_col, low, high)
    )


def is_missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    c = F.col(f"`{column}`")
    return (c.isNull() | F.isnan(c)) if kind in ("double", "float") else c.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, as count and percentage, worst first. One pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(is_missing(df, c)).alias(f"__c{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(f"__c{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ])
    return (
        counts.select("__rows", F.inline(rows))
        .orderBy(F.desc("missing_count"), "i")
        .select("column", "missing_count", (F.try_divide("missing_count", "__rows") * 100).alias("missing_pct"))
    )


def fill_missing(
    df: DataFrame,
    categories: Sequence[str] = (),
    texts: Sequence[str] = (),
    numbers: Sequence[str] = (),
) -> DataFrame:
    """Category → 'missing', text → '', number → 0."""
    changes = {c: F.coalesce(F.col(c).cast("string"), F.lit("missing")) for c in categories}
    changes |= {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts}
    changes |= {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in numbers}
    return df.withColumns(changes) if changes else df
