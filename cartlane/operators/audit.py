"""The integrity rules of the tables as audits.

Rules about one row are counted for a whole table in one pass. Unique keys and references
count per key before anything is shuffled, so a frequent key costs one row per task.

``audit_together`` takes all rules of many tables at once: one pass over each table for the rules
about rows, and one for keys, of which every rule's go through the same shuffle, as 128 bits and a
number for the rule.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.functions.times import to_second
from cartlane.schemas import TABLES, Table
from cartlane.sources.tables import literal_rows

NOT_NULL, DOMAIN, LENGTH, DECIMAL = "not_null", "domain", "length", "decimal"
UNIQUE, REFERENCE_KEY, TOTALS = "unique", "reference", "totals"


def breaks_not_null(column: Column) -> Column:
    return column.isNull()


def breaks_domain(column: Column, values) -> Column:
    return column.isNotNull() & ~column.isin(*values)


def breaks_length(column: Column, longest: int) -> Column:
    return F.char_length(column) > longest


def breaks_decimal(column: Column, precision: int, scale: int) -> Column:
    """True where rounding to ``scale`` places still leaves too many digits."""
    return column.isNotNull() & column.try_cast(f"decimal({precision},{scale})").isNull()


def row_rules(table: Table, columns: list[str]) -> list[tuple[str, str, Column]]:
    """Rule, column and violation test for each rule that looks at one row."""
    rules = []
    for c in table.columns:
        if c.name not in columns:
            continue
        here = F.col(c.name)
        if c.required:
            rules.append((NOT_NULL, c.name, breaks_not_null(here)))
        if c.domain:
            rules.append((DOMAIN, c.name, breaks_domain(here, c.domain)))
        if c.max_length:
            rules.append((LENGTH, c.name, breaks_length(here, c.max_length)))
        if c.decimal:
            rules.append((DECIMAL, c.name, breaks_decimal(here, *c.decimal)))
    return rules


def count_row_violations(df: DataFrame, table_name: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One report row per rule, all counted in one pass over the table."""
    counts = df.agg(*[F.count_if(test).alias(f"v{i}") for i, (_, _, test) in enumerate(rules)])
    entries = F.array(
        *[
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(column).alias("columns"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Keys with a null are never equal."""
    return (
        df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Values of a reference that the parent lacks, with the number of rows that hold them."""
    held = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return held.join(parent.select(F.col(parent_key).alias(column)).distinct(), column, "left_anti")


def _present(key: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in key])


def _tagged(keys: list[list[str]], value) -> Column:
    """An array with the number and ``value`` of each key that has no null."""
    found = [F.when(_present(k), F.struct(F.lit(i).alias("tag"), value(k))) for i, k in enumerate(keys)]
    return F.filter(F.array(*found), lambda entry: entry.isNotNull())


def duplicate_keys_of(df: DataFrame, keys: list[list[str]]) -> DataFrame:
    """``columns, key, rows``: for several unique keys, the values that occur more than once.

    The table is read twice for any number of keys. First the keys' hashes are counted, in one
    shuffle of 12 bytes a key; then the keys whose hash came once are left out, which are nearly all
    in a sound table, and the rest are counted as they are. ``key`` has the values as text.
    """
    hashed = df.select(F.inline(_tagged(keys, lambda k: F.xxhash64(*k).alias("hash"))))
    twice = hashed.groupBy("tag", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("tag", "hash")

    def whole(key: list[str]) -> Column:
        values = F.array(*[F.col(c).cast("string") for c in key])
        return F.struct(F.xxhash64(*key).alias("hash"), values.alias("key")).alias("entry")

    entries = df.select(F.inline(_tagged(keys, whole))).select("tag", "entry.*")
    found = entries.join(twice, ["tag", "hash"], "left_semi").groupBy("tag", "key").agg(F.count(F.lit(1)).alias("rows"))
    names = F.element_at(F.array(*[F.lit(",".join(k)) for k in keys]), F.col("tag") + 1)
    return found.filter("rows > 1").select(names.alias("columns"), "key", "rows")


def breaks_total() -> Column:
    """True where the total differs by more than a cent from amount + tax - discount."""
    total = F.col("order_amount") + F.col("tax_amount") - F.col("discount_amount")
    return F.abs(total - F.col("total_amount")) > F.lit("0.01").cast("decimal(3,2)")


def wrong_totals(orders: DataFrame) -> DataFrame:
    """Orders whose total differs by more than a cent from amount + tax - discount."""
    return orders.filter(breaks_total())


def _entry(df: DataFrame, table_name: str, rule: str, columns: list[str], violations: Column) -> DataFrame:
    return df.agg(violations.alias("violations")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(",".join(columns)).alias("columns"),
        "violations",
    )


def unique_entry(df: DataFrame, table_name: str, key: list[str]) -> DataFrame:
    """Counts the rows beyond the first of each key."""
    return _entry(duplicate_keys(df, key), table_name, UNIQUE, key, F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)))


def reference_entry(df: DataFrame, table_name: str, column: str, parent: DataFrame) -> DataFrame:
    found = F.coalesce(F.sum("rows"), F.lit(0))
    return _entry(orphans(df, column, parent), table_name, REFERENCE_KEY, [column], found)


def totals_entry(df: DataFrame, table_name: str) -> DataFrame:
    return _entry(wrong_totals(df), table_name, TOTALS, ["total_amount"], F.count(F.lit(1)))


def audit_table(table: Table, frames: dict[str, DataFrame]) -> DataFrame:
    """The report of one table: ``table_name, rule, columns, violations``.

    ``frames`` holds the table and the parents it refers to by name; rules on columns or
    parents that are not there are left out.
    """
    df = frames[table.name]
    present = set(df.columns)
    parts = []
    rules = row_rules(table, df.columns)
    if rules:
        parts.append(count_row_violations(df, table.name, rules))
    parts += [unique_entry(df, table.name, list(k)) for k in (("id",), *table.unique) if present.issuperset(k)]
    parts += [
        reference_entry(df, table.name, column, frames[parent])
        for column, parent in table.references.items()
        if column in present and parent in frames
    ]
    if table.name == "orders" and present.issuperset({"order_amount", "tax_amount", "discount_amount", "total_amount"}):
        parts.append(totals_entry(df, table.name))
    return reduce(DataFrame.unionByName, parts)


_AMOUNTS = {"order_amount", "tax_amount", "discount_amount", "total_amount"}


def audit_together(frames: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """The reports of several tables as one: ``table_name, rule, columns, violations``.

    ``frames`` holds those tables and the parents they refer to by name; rules on columns or parents
    that are not there are left out. Each table is read twice at most, a parent that is not audited
    itself once, and the keys of all rules are shuffled together.
    """
    parts, rules = [], []
    entries: dict[str, list[Column]] = {}

    def enter(table: str, key: list[str], tag: int, rows: int, parents: int) -> None:
        # Two hashes with the tag as part of them: 128 bits stand for the key.
        text = [F.col(c).cast("string") for c in key]
        halves = [F.xxhash64(F.lit(half), *text).alias(f"hash{half}") for half in (0, 1)]
        counts = [F.lit(rows).cast("long").alias("rows"), F.lit(parents).cast("long").alias("parents")]
        entry = F.struct(F.lit(tag).alias("tag"), *halves, *counts)
        entries.setdefault(table, []).append(F.when(_present(key), entry))

    for name in names:
        table, present = TABLES[name], set(frames[name].columns)
        tests = row_rules(table, frames[name].columns)
        if name == "orders" and present >= _AMOUNTS:
            tests.append((TOTALS, "total_amount", breaks_total()))
        if tests:
            parts.append(count_row_violations(frames[name], name, tests))
        for key in (("id",), *table.unique):
            if present.issuperset(key):
                enter(name, list(key), len(rules), 1, 0)
                rules.append((name, UNIQUE, ",".join(key), len(rules)))
        for column, parent in table.references.items():
            if column in present and parent in frames:
                enter(name, [column], len(rules), 1, 0)
                enter(parent, ["id"], len(rules), 0, 1)
                rules.append((name, REFERENCE_KEY, column, len(rules)))
    if rules:
        tagged = [
            frames[name].select(F.inline(F.filter(F.array(*found), lambda entry: entry.isNotNull()))) for name, found in entries.items()
        ]
        keys = reduce(DataFrame.unionByName, tagged).groupBy("tag", "hash0", "hash1")
        counted = keys.agg(F.sum("rows").alias("rows"), F.sum("parents").alias("parents"))
        unique = F.col("tag").isin([tag for _, rule, _, tag in rules if rule == UNIQUE])
        wrong = F.when(unique, F.col("rows") - 1).when(F.col("parents") == 0, F.col("rows")).otherwise(F.lit(0))
        # One row per rule.
        found = counted.groupBy("tag").agg(F.sum(wrong).alias("violations"))
        listed = literal_rows(frames[names[0]].sparkSession, ["table_name", "rule", "columns", "tag"], rules)
        report = listed.join(found, listed["tag"] == found["tag"], "left")
        parts.append(report.select("table_name", "rule", "columns", F.coalesce("violations", F.lit(0)).alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def fill_defaults(df: DataFrame, table: Table, now: Column) -> DataFrame:
    """Nulls of columns with a default replaced by it; columns not supplied are added."""
    columns = {}
    for c in table.columns:
        default = now if c.default == "now" or (c.name == "created_at" and c.required) else c.default
        if default is None:
            continue
        value = (default if isinstance(default, Column) else F.lit(default)).cast(c.spark_type())
        columns[c.name] = F.coalesce(F.col(c.name), value) if c.name in df.columns else value
    return df.withColumns(columns)


def stored(df: DataFrame, table: Table) -> DataFrame:
    """Columns cast to the types of the table: amounts and times rounded as it stores them."""
    columns = {}
    for c in table.columns:
        if c.name not in df.columns:
            continue
        value = F.col(c.name).cast(c.spark_type())
        columns[c.name] = to_second(value) if c.type == "timestamp(0)" else value
    return df.withColumns(columns)
