"""Exact comparison of tables as multisets of rows.

First each table gives a digest per bucket of rows: their number and the sum of 128-bit
hashes, which does not depend on the order of rows, nor on how they are spread. Only digests
are shuffled for that. Buckets whose digests agree hold equal multisets; the rows of the others
are counted exactly, in one shuffle for all tables together: equal rows merge in the map
tasks, and no table is joined with another. The keys are the typed values; what grouping
would merge and the canonical text keeps apart, the sign of a zero, is one more key. The
canonical text itself is written only for the examples.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.functions.canonical import canonical_record, canonical_value, is_negative_zero, kinds_of

# Buckets of rows with a digest of their own. Their numbers reach the driver, so they are bounded.
BUCKETS = 4096
# About what a field takes in a shuffled row, and a text on top of that.
FIELD_BYTES = 8
TEXT_BYTES = 32
_ZEROS = "_negative_zeros"
_WIDEST = {"integer": "long", "float": "double", "text": "string", "bool": "boolean", "null": "string"}


def multiplicities(tables: dict[str, DataFrame], columns: list[str] | None = None, within: list[int] | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """Every distinct row of any table, with its number of copies in each (`n_<name>`).

    `within` names the buckets of rows to count, of `buckets`; all, if it is not given.
    """
    columns = columns or next(iter(tables.values())).columns
    common = common_kinds(tables, columns)
    tagged = []
    for own, df in tables.items():
        keys = _keys(df, columns, common)
        if within is not None and len(within) < buckets:
            keys = _of_buckets(keys, columns, within, buckets)
        tagged.append(keys.withColumns({f"n_{name}": F.lit(1 if name == own else 0).cast("long") for name in tables}))
    union = reduce(DataFrame.unionAll, tagged)
    counted = union.groupBy(*columns, _ZEROS).agg(*[F.sum(f"n_{name}").alias(f"n_{name}") for name in tables])
    return counted.select(
        *[_signed(c, i, common[c]) for i, c in enumerate(columns)], *[f"n_{name}" for name in tables])


def counted_bytes(tables: dict[str, DataFrame], rows: int, columns: list[str] | None = None) -> int:
    """About what as many rows of the tables take in the shuffle of `multiplicities`, were no two equal.

    Files tell little of it: there a column of few texts takes a few bits a row.
    """
    columns = columns or next(iter(tables.values())).columns
    texts = sum(kind in ("text", "tagged") for kind in common_kinds(tables, columns).values())
    return rows * (FIELD_BYTES * (len(columns) + 1 + len(tables)) + TEXT_BYTES * texts)


def common_kinds(tables: dict[str, DataFrame], columns: list[str]) -> dict[str, str]:
    """The kind under which a column is compared.

    Where the tables disagree, only nulls can be equal; such a column is compared by its
    canonical text.
    """
    kinds = [kinds_of(df, columns) for df in tables.values()]
    common = {}
    for column in columns:
        found = {k[column] for k in kinds} - {"null"}
        common[column] = "tagged" if len(found) > 1 else next(iter(found), "null")
    return common


def row_multiplicity(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every distinct row with its number of copies."""
    return multiplicities({"rows": df}, columns).withColumnRenamed("n_rows", "n")


def unmatched(own: str, other: str) -> Column:
    """Copies of a row in one table beyond those in the other."""
    return F.greatest(F.col(f"n_{own}") - F.col(f"n_{other}"), F.lit(0))


def bucket_digests(tables: dict[str, DataFrame], columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """bucket, and per table a struct of the rows in it and the four sums of their hash.

    The sums are of 32 bits each, so they stay in a long for 2**31 rows a bucket.
    """
    columns = columns or next(iter(tables.values())).columns
    common = common_kinds(tables, columns)
    low = F.lit((1 << 32) - 1)
    parts = []
    for name, df in tables.items():
        hashed = _keys(df, columns, common).select(
            F.lit(name).alias("table"), F.xxhash64(*columns, _ZEROS).alias("a"), F.xxhash64(F.lit(1), *columns, _ZEROS).alias("b"))
        parts.append(hashed.select(
            "table", _bucket(F.col("a"), buckets).alias("bucket"), F.shiftrightunsigned("a", 32).alias("a1"), F.col("a").bitwiseAND(low).alias("a2"),
            F.shiftrightunsigned("b", 32).alias("b1"), F.col("b").bitwiseAND(low).alias("b2")))
    sums = reduce(DataFrame.unionAll, parts).groupBy("bucket", "table").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in ("a1", "a2", "b1", "b2")])
    digest = F.struct("rows", "a1", "a2", "b1", "b2")
    return sums.groupBy("bucket").agg(*[F.max(F.when(F.col("table") == name, digest)).alias(name) for name in tables])


def differing_buckets(tables: dict[str, DataFrame], pairs: list[tuple[str, str]], columns: list[str] | None = None,
                      buckets: int = BUCKETS) -> list[int]:
    """Buckets in which the tables of some pair differ: at most `buckets` numbers."""
    other = [~F.col(f"`{left}`").eqNullSafe(F.col(f"`{right}`")) for left, right in pairs]
    digests = bucket_digests(tables, columns, buckets)
    return sorted(row["bucket"] for row in digests.filter(reduce(or_, other)).select("bucket").collect())


def differing_rows(tables: dict[str, DataFrame], pairs: list[tuple[str, str]] | None = None, columns: list[str] | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """Every distinct row that some pair of tables holds in different numbers, with its number in each (`n_<name>`)."""
    pairs = pairs or pairs_of(tables)
    columns = columns or next(iter(tables.values())).columns
    counted = multiplicities(tables, columns, differing_buckets(tables, pairs, columns, buckets), buckets)
    return counted.filter(reduce(or_, [F.col(f"n_{left}") != F.col(f"n_{right}") for left, right in pairs]))


def pairs_of(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """The first table with each of the others."""
    names = list(tables)
    return [(names[0], name) for name in names[1:]]


def unmatched_rows(differing: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """For each pair of tables: unmatched copies both ways and whether the multisets are equal."""
    sums = differing.agg(*[
        F.coalesce(F.sum(unmatched(own, other)), F.lit(0)).alias(f"{own}|{other}")
        for left, right in pairs for own, other in ((left, right), (right, left))
    ])
    rows = F.array(*[
        F.struct(
            F.lit(left).alias("left"), F.lit(right).alias("right"),
            ((F.col(f"{left}|{right}") == 0) & (F.col(f"{right}|{left}") == 0)).alias("equal_values_with_multiplicity"),
            F.col(f"{left}|{right}").alias("left_unmatched_row_instances"),
            F.col(f"{right}|{left}").alias("right_unmatched_row_instances"),
        ) for left, right in pairs
    ])
    return sums.select(F.inline(rows))


def diff_multiset(tables: dict[str, DataFrame], pairs: list[tuple[str, str]] | None = None,
                  columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """For each pair of tables: unmatched copies both ways and whether the multisets are equal."""
    pairs = pairs or pairs_of(tables)
    return unmatched_rows(differing_rows(tables, pairs, columns, buckets), pairs)


def pair_examples(differing: DataFrame, tables: dict[str, DataFrame], pairs: list[tuple[str, str]], examples: int = 3,
                  columns: list[str] | None = None) -> DataFrame:
    """left, right, side and the first few rows, by canonical text, that a side has more often than the other.

    All pairs come from the same counted rows. The rank limit is applied in every map task
    before the shuffle, so a side sends a handful of rows per task however many differ.
    """
    columns = columns or next(iter(tables.values())).columns
    found = []
    for left, right in pairs:
        n_left, n_right = F.col(f"n_{left}"), F.col(f"n_{right}")
        found.append(F.when(n_left != n_right, F.struct(
            F.lit(left).alias("left"), F.lit(right).alias("right"),
            F.when(n_left > n_right, F.lit(left)).otherwise(F.lit(right)).alias("side"),
            F.greatest(n_left, n_right).alias("count_on_side"), F.least(n_left, n_right).alias("count_on_other"))))
    record = canonical_record(common_kinds(tables, columns)).alias("encoded_record")
    records = differing.select(record, F.explode(F.filter(F.array(*found), lambda e: e.isNotNull())).alias("pair")).select("pair.*", "encoded_record")
    rank = F.row_number().over(Window.partitionBy("left", "right", "side").orderBy("encoded_record"))
    return records.withColumn("rank", rank).filter(F.col("rank") <= examples)


def diff_examples(left: DataFrame, right: DataFrame, examples: int = 3, names: tuple[str, str] = ("left", "right"),
                  columns: list[str] | None = None) -> DataFrame:
    """The examples of one pair of tables."""
    tables, pairs = {names[0]: left, names[1]: right}, [names]
    return pair_examples(differing_rows(tables, pairs, columns), tables, pairs, examples, columns).drop("left", "right")


def _keys(df: DataFrame, columns: list[str], common: dict[str, str]) -> DataFrame:
    own = kinds_of(df, columns)
    keys = [
        (canonical_value(F.col(c), own[c]) if common[c] == "tagged" else F.col(c).cast(_WIDEST[common[c]])).alias(c)
        for c in columns
    ]
    bits = [
        F.when(is_negative_zero(F.col(c)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        for i, c in enumerate(columns) if common[c] == "float"
    ]
    return df.select(*keys, reduce(add, bits, F.lit(0).cast("long")).alias(_ZEROS))


def _of_buckets(keys: DataFrame, columns: list[str], within: list[int], buckets: int) -> DataFrame:
    """The rows of some buckets.

    Their numbers are joined, at most `buckets` of them: a filter over a hash of all columns
    would be taken apart by the optimizer, once for every way to write each column.
    """
    if not within:
        return keys.filter(F.lit(False))
    wanted = keys.sparkSession.createDataFrame([(b,) for b in within], "_bucket int")
    own = F.coalesce(_bucket(F.xxhash64(*columns, _ZEROS), buckets), F.lit(-1))
    return keys.withColumn("_bucket", own).join(F.broadcast(wanted), "_bucket", "left_semi").drop("_bucket")


def _bucket(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def _signed(column: str, bit: int, kind: str) -> Column:
    if kind != "float":
        return F.col(column)
    negative = F.col(_ZEROS).bitwiseAND(F.lit(1 << bit).cast("long")) != 0
    return F.when(negative, F.lit(-0.0)).otherwise(F.col(column)).alias(column)
