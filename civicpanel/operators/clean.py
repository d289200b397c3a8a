"""Typing and cleaning whole tables.

The expressions live in :mod:`civicpanel.functions`; here they are applied to
frames, with the number of values lost to each conversion as a second result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicpanel.functions import conversion, text
from civicpanel.sizing import small_side

Expression = Callable[[Column], Column]


def clean_table(df: DataFrame, spec: Mapping[str, Expression]) -> tuple[DataFrame, DataFrame]:
    """Apply one expression per column and report what each of them lost.

    Returns ``(clean, rejects)``.  ``rejects`` has one row per column of
    ``spec``: rows read, rows with a non-blank input, and rows where such an
    input became NULL.  It is one aggregate over one scan.
    """
    clean = df.withColumns({name: parse(F.col(name)) for name, parse in spec.items()})

    def counts(name: str, parse: Expression) -> Column:
        source = F.col(name)
        filled = source.isNotNull() & (F.trim(source.cast("string")) != "")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(filled).alias("n_filled"),
            F.count_if(filled & parse(source).isNull()).alias("n_rejected"),
        )

    totals = df.agg(F.array(*[counts(name, parse) for name, parse in spec.items()]).alias("c"))
    return clean, totals.select(F.inline("c"))


def clean_observed(
    df: DataFrame, spec: Mapping[str, Expression], name: str = "rejects"
) -> tuple[DataFrame, Observation]:
    """As :func:`clean_table`, counted in the pass that writes the clean rows.

    The observation is filled once an action has computed all clean rows; read it
    with :func:`observed_rejects`.
    """
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for number, (column, parse) in enumerate(spec.items()):
        source = F.col(column)
        filled = source.isNotNull() & (F.trim(source.cast("string")) != "")
        counts += [
            F.count_if(filled).alias(f"filled_{number}"),
            F.count_if(filled & parse(source).isNull()).alias(f"rejected_{number}"),
        ]
    clean = df.observe(seen, *counts).withColumns({c: parse(F.col(c)) for c, parse in spec.items()})
    return clean, seen


def observed_rejects(spark: SparkSession, seen: Observation, columns: Sequence[str]) -> DataFrame:
    """The counts of :func:`clean_observed` in the columns of :func:`clean_table`'s rejects."""
    found = seen.get
    rows = [
        (column, found["n_rows"], found[f"filled_{number}"], found[f"rejected_{number}"])
        for number, column in enumerate(columns)
    ]
    return spark.createDataFrame(rows, "column string, n_rows bigint, n_filled bigint, n_rejected bigint")


def casts(types: Mapping[str, str]) -> dict[str, Expression]:
    """One safe conversion per column, for :func:`clean_table` and :func:`clean_observed`."""
    return {name: lambda c, dtype=dtype: conversion.safe(c, dtype) for name, dtype in types.items()}


def strict_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not convert stops the job."""
    return df.withColumns(
        {name: conversion.strict(F.col(name), dtype, name) for name, dtype in types.items()}
    )


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns, bad values to NULL, with the reject counts beside the result."""
    return clean_table(df, casts(types))


def parse_brl(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """Brazilian number text to numbers."""
    return df.withColumns({name: conversion.brl(F.col(name), dtype) for name in columns})


def decimal_comma(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Decimal comma to decimal point in text columns."""
    return df.withColumns({name: conversion.decimal_comma(F.col(name)) for name in columns})


def bounded_int(df: DataFrame, column: str, low: int, high: int, out: str | None = None) -> DataFrame:
    """Integers within bounds; the rest NULL."""
    return df.withColumn(out or column, conversion.bounded_int(F.col(column), low, high))


def fix_names(
    df: DataFrame,
    column: str,
    exact: Mapping[str, str],
    prefix: Mapping[str, str] | None = None,
    out: str | None = None,
) -> DataFrame:
    """Known spelling corrections of a name column."""
    return df.withColumn(out or column, text.fix_names(F.col(column), exact, prefix))


def fix_names_from_table(
    df: DataFrame, column: str, rules: DataFrame, wrong: str, right: str, out: str | None = None
) -> DataFrame:
    """Corrections held in a table, one row per misspelling, for long lists of rules."""
    lookup = rules.select(F.col(wrong).alias("_wrong"), F.col(right).alias("_right"))
    joined = df.join(small_side(lookup), F.col(column) == F.col("_wrong"), "left")
    return joined.withColumn(out or column, F.coalesce("_right", column)).drop("_wrong", "_right")


def state_name_to_code(
    df: DataFrame, column: str, out: str, names: Mapping[str, str] | None = None
) -> DataFrame:
    """State names or codes to two-letter codes."""
    return df.withColumn(out, text.state_code(F.col(column), names))


def classify(
    df: DataFrame,
    column: str,
    groups: Mapping[str, Sequence[str]],
    out: str,
    default: str | None = None,
) -> DataFrame:
    """Group label of a code."""
    return df.withColumn(out, text.classify(F.col(column), groups, default))


def name_key(
    df: DataFrame, column: str, out: str, accent: bool = True, case: bool = True
) -> DataFrame:
    """Comparable key of a name column."""
    return df.withColumn(out, text.name_key(F.col(column), accent, case))


def split_part_safe(
    df: DataFrame, column: str, sep: str, index: int, out: str, strict: bool = False
) -> DataFrame:
    """One part of delimited text."""
    return df.withColumn(out, text.split_part(F.col(column), sep, index, strict))


def coalesce_wide(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """First non-null of many sparse columns, which are dropped."""
    return df.withColumn(out, F.coalesce(*columns)).drop(*[c for c in columns if c != out])


def hash_key(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """SHA-256 key of several columns."""
    return df.withColumn(out, text.hash_key(*[F.col(name) for name in columns]))


# Protected columns of each tag.
SENSITIVE_TAGS = {
    "TAG_CPF": ["cpf"],
    "TAG_NIS": ["nis"],
    "TAG_NOME": ["nome_pessoa", "nome"],
    "TAG_DATA_NASCIMENTO": ["data_nascimento"],
    "TAG_ETNIA": ["cor_raca"],
    "TAG_GENERO": ["sexo"],
}


def _tagged(df: DataFrame, tags: Mapping[str, Sequence[str]]) -> list[str]:
    protected = {name.lower() for names in tags.values() for name in names}
    return [name for name in df.columns if name.lower() in protected]


def drop_sensitive(df: DataFrame, tags: Mapping[str, Sequence[str]] = SENSITIVE_TAGS) -> DataFrame:
    """Remove every column that a tag protects."""
    return df.drop(*_tagged(df, tags))


def mask_sensitive(
    df: DataFrame,
    tags: Mapping[str, Sequence[str]] = SENSITIVE_TAGS,
    keep_joinable: Sequence[str] = (),
    key: bytes | None = None,
) -> DataFrame:
    """Replace protected values by ``***``, or by a keyed hash for ``keep_joinable`` columns.

    Tables masked with one ``key`` join on the hashes; without the key they cannot be
    turned back by hashing all possible numbers.
    """
    if keep_joinable and not key:
        raise ValueError("columns that stay joinable need a key")

    def masked(name: str) -> Column:
        value = text.hmac_sha256(F.col(name), key) if name in keep_joinable else F.lit("***")
        return F.when(F.col(name).isNotNull(), value)

    return df.withColumns({name: masked(name) for name in _tagged(df, tags)})


def sanitize_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """White space and control characters cleaned."""
    return df.withColumns({name: text.sanitize(F.col(name)) for name in columns})


def null_if_invalid(df: DataFrame, columns: Sequence[str], invalid: Sequence[str]) -> DataFrame:
    """Markers such as ``N/A`` and blank text to NULL."""
    return df.withColumns({c: conversion.null_if_invalid(F.col(c), invalid) for c in columns})


def handle_null(df: DataFrame, defaults: Mapping) -> DataFrame:
    """Defaults in place of NULL, per column."""
    return df.withColumns({c: conversion.handle_null(F.col(c), d) for c, d in defaults.items()})


def convert_type(df: DataFrame, column: str, dtype: str, default=None) -> DataFrame:
    """Convert, with ``default`` where the value does not convert or is NULL."""
    value = conversion.safe(F.col(column), dtype)
    return df.withColumn(
        column, value if default is None else F.coalesce(value, F.lit(default).cast(dtype))
    )


def parse_dates(
    df: DataFrame, column: str, formats: Sequence[str], out: str | None = None, strict: bool = False
) -> DataFrame:
    """Date text in one of several formats; ``strict`` refuses anything else."""
    value = conversion.first_date(F.col(column), formats)
    if strict:
        message = F.concat(F.lit(f"column {column} is not a date: "), F.col(column))
        value = F.when(
            F.col(column).isNotNull() & value.isNull(), F.raise_error(message).cast("date")
        ).otherwise(value)
    return df.withColumn(out or column, value)


def decode(
    df: DataFrame, column: str, labels: Mapping, out: str | None = None, default: str | None = None
) -> DataFrame:
    """Labels of coded values."""
    return df.withColumn(out or column, text.decode(F.col(column), labels, default))


def strip_suffix(df: DataFrame, column: str, suffix: str, out: str | None = None) -> DataFrame:
    """Identifier without its suffix."""
    return df.withColumn(out or column, text.strip_suffix(F.col(column), suffix))


def harmonize_versions(versions: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Versions of one source with different column names, as one table.

    A column that a version lacks is NULL there.
    """
    renamed = [df.withColumnsRenamed(dict(names)) for df, names in versions]
    result = renamed[0]
    for df in renamed[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def robust_indicator(df: DataFrame, flag: str, quantity: str, out: str | None = None) -> DataFrame:
    """The flag where it is filled in, else ``quantity > 0``."""
    return df.withColumn(out or flag, F.coalesce(F.col(flag), F.col(quantity) > 0))


def require_non_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every listed column holds text."""
    for name in columns:
        df = df.where(F.trim(F.col(name)) != "")
    return df


def filter_ci(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows equal to ``value`` without regard to case."""
    return df.where(text.eq_ci(F.col(column), value))


def exclude_status(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose status is known and not listed."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def is_true(df: DataFrame, column: str) -> DataFrame:
    """Rows whose flag is true; NULL is not."""
    return df.where(F.col(column))


def select_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns but the listed ones; a name that does not exist is an error."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.drop(*columns)


def name_case(df: DataFrame, column: str, default: str | None = None, out: str | None = None) -> DataFrame:
    """Display case of a name column."""
    return df.withColumn(out or column, text.name_case(F.col(column), default))


def presence_flags(df: DataFrame, flags: Mapping[str, Sequence[Column] | Column]) -> DataFrame:
    """0/1 flags; several conditions of one flag are alternatives."""
    return df.withColumns(
        {
            out: text.presence(*([given] if isinstance(given, Column) else given))
            for out, given in flags.items()
        }
    )


def prefix_filter(df: DataFrame, column: str, prefix: str, negate: bool = False) -> DataFrame:
    """Rows whose text starts with ``prefix`` (or does not); NULL is never kept.

    ``startswith`` reaches Parquet as a string filter, which ``substring`` does not.
    """
    condition = F.col(column).startswith(prefix)
    return df.where(~condition if negate else condition)


def length_filter(df: DataFrame, column: str, length: int) -> DataFrame:
    """Rows whose code has exactly ``length`` characters."""
    return df.where(F.length(column) == length)


def numeric_code_filter(df: DataFrame, column: str, op: str, value: int, strict: bool = False) -> DataFrame:
    """Rows whose code, read as a number, compares with ``value`` by ``<`` or ``>``.

    Codes that are not numbers are left out, or stop the job if ``strict``.
    """
    code = (
        conversion.strict(F.col(column), "bigint", column)
        if strict
        else F.col(column).try_cast("bigint")
    )
    if op not in ("<", ">"):
        raise ValueError(f"unsupported comparison: {op}")
    return df.where(code < value if op == "<" else code > value)
