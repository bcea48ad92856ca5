"""Constraints as queries: each returns the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.schemas import Table


class ConstraintViolation(Exception):
    pass


def required(df: DataFrame, holds: Column, failure: Column) -> DataFrame:
    """``df``, or a failure where a row does not hold.

    A row filter: unlike a check that hangs on an output column, it is there
    whichever columns are read later, and for a mere count.
    """
    fail = F.raise_error(failure).cast("boolean")
    return df.filter(F.when(F.coalesce(holds, F.lit(False)), F.lit(True)).otherwise(fail))


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``.

    As in SQL, a key with a NULL part equals no other; a primary key's columns
    are NOT NULL besides.
    """
    whole = reduce(and_, [F.col(name).isNotNull() for name in keys])
    return df.filter(whole).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(or_, [F.col(name).isNull() for name in columns]))


def fk_orphans(df: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key names no parent row; a NULL foreign key passes.

    ``parent_key`` is expected to be a key of the parent.
    """
    known = parent.select(F.col(parent_key).alias(foreign_key))
    return df.filter(F.col(foreign_key).isNotNull()).join(known, foreign_key, "left_anti")


def _too_long(column: str, length: int) -> Column:
    # Blanks beyond the limit are trimmed on assignment, not rejected.
    return F.length(F.rtrim(F.col(column))) > length


def varchar_violations(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    return df.filter(reduce(or_, [_too_long(name, n) for name, n in lengths.items()]))


def assign_varchars(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Fit columns to VARCHAR(n) in the same pass: trim blanks, fail on the rest."""

    fits = reduce(and_, [~F.coalesce(_too_long(name, n), F.lit(False)) for name, n in lengths.items()])
    # Names the first column that does not fit.
    failure = F.coalesce(
        *[
            F.when(_too_long(name, n), F.lit(f"value too long for '{name}' varchar({n})"))
            for name, n in lengths.items()
        ],
        F.lit(""),
    )

    def fitted(name: str, n: int) -> Column:
        return F.when(F.length(name) <= n, F.col(name)).otherwise(F.substring(name, 1, n))

    checked = required(df, fits, failure)
    return checked.withColumns({name: fitted(name, n) for name, n in lengths.items()})


def enforce(violations: DataFrame, rule: str, mode: str = "fail") -> DataFrame:
    """``fail`` raises if there is any violating row; ``report`` hands them on."""
    if mode not in ("fail", "report"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "fail":
        example = violations.first()
        if example is not None:
            raise ConstraintViolation(f"{rule}: for example {example.asDict()}")
    return violations


def table_violations(
    df: DataFrame, table: Table, parents: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The violating rows of every rule the table declares, by rule."""
    rules = {
        f"{table.name}.{key} has to be unique": unique_violations(df, [key])
        for key in (table.primary_key, *table.unique)
    }
    for name in table.not_null:
        rules[f"{table.name}.{name} has to be not null"] = not_null_violations(df, [name])
    for name, length in table.lengths.items():
        rules[f"{table.name}.{name} is varchar({length})"] = varchar_violations(df, {name: length})
    for name, (parent, key) in table.foreign_keys.items():
        rules[f"{table.name}.{name} has to be in {parent}"] = fk_orphans(
            df, name, parents[parent], key
        )
    return rules


def violations_in_one_pass(
    df: DataFrame, table: Table, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """(rule, key, n): every breach of the table's rules, from one scan of it and one grouping.

    Each row is expanded to what its rules have to say: the value of every key
    and foreign key, and each length or not-null rule that it breaks itself.
    Parents add the keys they have. Grouped by rule and value, a key with more
    than one row and a foreign key without a parent are breaches. ``key`` is the
    value in question as text, for a row's own breach that of the primary key;
    ``n`` is the number of rows.
    """

    def said(rule: str, value: Column, rows: int = 1, known: bool = False) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), value.cast("string").alias("key"),
            F.lit(rows).cast("bigint").alias("rows"), F.lit(known).alias("known"),
        )

    own, keys, references = F.col(table.primary_key), [], {}
    parts = []
    for name in (table.primary_key, *table.unique):
        rule = f"{table.name}.{name} has to be unique"
        keys.append(rule)
        parts.append(F.when(F.col(name).isNotNull(), said(rule, F.col(name))))
    for name in table.not_null:
        parts.append(F.when(F.col(name).isNull(), said(f"{table.name}.{name} has to be not null", own)))
    for name, length in table.lengths.items():
        parts.append(F.when(_too_long(name, length), said(f"{table.name}.{name} is varchar({length})", own)))
    for name, (parent, key) in table.foreign_keys.items():
        rule = f"{table.name}.{name} has to be in {parent}"
        references[rule] = (parents[parent], key)
        parts.append(F.when(F.col(name).isNotNull(), said(rule, F.col(name))))
    heard = df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.*")
    for rule, (parent, key) in references.items():
        heard = heard.unionByName(parent.select(said(rule, F.col(key), 0, True).alias("x")).select("x.*"))
    found = heard.groupBy("rule", "key").agg(F.sum("rows").alias("n"), F.max("known").alias("known"))
    broken = F.when(F.col("rule").isin(*keys), F.col("n") > 1).when(
        F.col("rule").isin(*references), (F.col("n") > 0) & ~F.col("known")
    )
    return found.filter(broken.otherwise(F.lit(True))).select("rule", "key", "n")


def enforce_table(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> None:
    """Fail on the first breach of any rule of the table; one job for all of them."""
    example = violations_in_one_pass(df, table, parents).first()
    if example is not None:
        raise ConstraintViolation(f"{example.rule}: for example {example.key} ({example.n} rows)")
