"""Joins. The optimizer picks the strategy: adaptive execution broadcasts a side whose shuffled size turned out small."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditional import _col


def _pairs(on):
    """Normalise a key list or a ``{left: right}`` mapping to (left, right) pairs."""
    if isinstance(on, str):
        return [(on, on)]
    return list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]


def all_of(conditions):
    """Conjunction of conditions."""
    return reduce(lambda p, q: p & q, conditions)


def _right(right, on, cols):
    """Right side with its keys renamed ``__k0, __k1, ...``, so that a table can meet itself."""
    return right.select(*[F.col(b).alias(f"__k{i}") for i, (_, b) in enumerate(_pairs(on))], *[_col(c) for c in cols])


def _match(left, on, blank_null=False, null_safe=False):
    terms = []
    for i, (a, _) in enumerate(_pairs(on)):
        x, y = left[a], F.col(f"__k{i}")
        if blank_null and isinstance(left.schema[a].dataType, T.StringType):
            terms.append(F.coalesce(x, F.lit("")) == F.coalesce(y, F.lit("")))
        else:
            terms.append(x.eqNullSafe(y) if null_safe or blank_null else x == y)
    return all_of(terms)


def _no_keys(df, on):
    return df.drop(*[f"__k{i}" for i in range(len(_pairs(on)))])


def _rest(right, on):
    keys = {b for _, b in _pairs(on)}
    return [c for c in right.columns if c not in keys]


def inner(left, right, on, blank_null=False, null_safe=False) -> DataFrame:
    """Inner equi-join that keeps the left key columns.

    ``blank_null`` reads NULL text keys as ``''`` and lets NULL keys of other types match; ``null_safe`` lets NULL match NULL.
    """
    other = _right(right, on, _rest(right, on))
    return _no_keys(left.join(other, _match(left, on, blank_null, null_safe), "inner"), on)


def star(fact, dims) -> DataFrame:
    """Join a fact to ``[(dimension, keys), ...]`` in turn."""
    return reduce(lambda acc, d: inner(acc, d[0], d[1]), dims, fact)


def lookup(df, dim, on, cols=None) -> DataFrame:
    """Left join to a lookup, taking ``cols`` from it."""
    right = _right(dim, on, _rest(dim, on) if cols is None else cols)
    return _no_keys(df.join(right, _match(df, on), "left"), on)


def anti(left, right, on, blank_null=False) -> DataFrame:
    """Rows of ``left`` without a partner (LEFT JOIN ... IS NULL, NOT EXISTS)."""
    return left.join(_right(right, on, []), _match(left, on, blank_null), "left_anti")


def semi(left, right, on) -> DataFrame:
    """Rows of ``left`` with a partner."""
    return left.join(_right(right, on, []), _match(left, on), "left_semi")


def exists_any(df, predicate) -> bool:
    """Whether any row satisfies the predicate; reads no further than the first."""
    return not df.filter(predicate).limit(1).isEmpty()


def changed(source, target, keys, hash_col="HashValue") -> DataFrame:
    """Source rows whose key is in the target under a different hash."""
    tgt = _right(target, keys, [F.col(hash_col).alias("__hash")])
    return source.join(tgt, _match(source, keys) & (source[hash_col] != F.col("__hash")), "left_semi")


def one_per_key(df, keys, order=None) -> DataFrame:
    """One row per key: the greatest by ``order``, or an error on a repeated key when no order is given.

    The choice is an aggregate, so repeats of a hot key collapse before the shuffle; the join
    on the same keys then reuses the partitioning.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("__one"))
    if order:
        picked = df.groupBy(*keys).agg(F.max_by(row, F.struct(*[_col(o) for o in order])).alias("__row"))
    else:
        picked = df.groupBy(*keys).agg(F.any_value(row).alias("__row"), F.count("*").alias("__n"))
        repeated = F.raise_error(F.concat_ws(" ", F.lit("repeated source key"), *[F.col(k).cast("string") for k in keys]))
        picked = picked.withColumn("__row", F.when(F.col("__n") > 1, repeated.cast(picked.schema["__row"].dataType))
                                   .otherwise(F.col("__row")))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def update_from(target, source, keys, mapping, order=None) -> DataFrame:
    """UPDATE ... FROM: set ``{target column: source column}`` on matched rows.

    A matched NULL overwrites; unmatched rows keep their values, and so do rows with a NULL key. Of a repeated source key the
    last row by ``order`` counts; without an order a repeated key is an error.
    """
    names = list(dict.fromkeys(b for _, b in _pairs(keys)))
    used = [c for c in dict.fromkeys([*names, *mapping.values(), *(order or [])])]
    source = one_per_key(source.select(*used).dropna(subset=names), names, order)
    src = _right(source, keys, [*[_col(s).alias(f"__v_{t}") for t, s in mapping.items()], F.lit(True).alias("__hit")])
    return target.join(src, _match(target, keys), "left").select(*[
        F.when(F.col("__hit"), F.col(f"__v_{c}")).otherwise(target[c]).alias(c) if c in mapping else target[c]
        for c in target.columns])


def lateral_json(df, col, schema, alias="item") -> DataFrame:
    """One row per element of a JSON array column, its fields beside the original columns."""
    parsed = F.from_json(F.col(col), schema)
    return df.select("*", F.explode(parsed).alias(alias)).select(*df.columns, f"{alias}.*")
