"""Joins of clearing data with dimensions, rates, buckets and stage outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.operators.filters import InputError
from clearspan.operators.lookup import lookup_join
from clearspan.operators.stabbing import best_of_each

WILDCARD = 255


def join_rate(
    facts: DataFrame, rates: DataFrame, keys: dict[str, str], rate: str, name: str, missing: Column | None = None
) -> DataFrame:
    """Rate by date and currencies, one row per key; ``missing`` fills absent rates."""
    one_each = rates.groupBy(*keys.values()).agg(F.max(rate).alias(rate))
    joined = lookup_join(facts, one_each, keys, {rate: name})
    return joined if missing is None else joined.withColumn(name, F.coalesce(F.col(name), missing))


def any_key_dimension(dim: DataFrame, key_columns: list[str], payload: list[str], best_first: list[Column]) -> DataFrame:
    """One row per spelling of a dimension's key; a spelling shared by rows goes to the first."""
    spelled = dim.withColumn("any_key", F.explode(F.array(*[F.upper(F.trim(F.col(c).cast("string"))) for c in key_columns])))
    filled = spelled.where("any_key <> ''")
    order = Window.partitionBy("any_key").orderBy(*best_first)
    return filled.withColumn("__n", F.row_number().over(order)).where("__n = 1").select("any_key", *payload)


def join_any_key(
    facts: DataFrame, dim: DataFrame, raw: Column, key_columns: list[str], take: dict[str, str], best_first: list[Column]
) -> DataFrame:
    """Look up a value that may be any of several spellings of the dimension's key."""
    single = any_key_dimension(dim, key_columns, list(take), best_first)
    return lookup_join(facts.withColumn("__raw", F.upper(F.trim(raw.cast("string")))), single, {"__raw": "any_key"}, take).drop("__raw")


def join_wildcard(facts: DataFrame, template: DataFrame, dims: dict[str, str], exact: dict[str, str], take: list[str]) -> DataFrame:
    """All template rows whose dimensions equal the row's or are the wildcard.

    ``dims`` and ``exact`` map fact columns to template columns. The few combinations of
    wildcards in use turn into plain equalities: a row probes once per combination with
    its other values, so there is no comparison of every row with every template row.
    """
    masked = [F.when(F.col(t) == WILDCARD, 1).otherwise(0).alias(t) for t in dims.values()]
    combos = sorted(tuple(r) for r in template.select(*masked).distinct().collect())
    options = []
    for combo in combos:
        cells = [
            (F.lit(WILDCARD) if wild else F.col(f)).cast("int").alias(f"__d{i}")
            for i, (f, wild) in enumerate(zip(dims, combo))
        ]
        options.append(F.struct(*cells, F.lit(int("".join(map(str, combo)), 2)).alias("__mask")))
    probes = facts.withColumn("__probe", F.explode(F.array(*options))) if options else facts
    if not options:
        return facts.select("*", *[F.lit(None).cast(template.schema[c].dataType).alias(c) for c in take])
    mask_of = sum((F.when(F.col(t) == WILDCARD, 1).otherwise(0) * 2 ** (len(dims) - 1 - i) for i, t in enumerate(dims.values())), F.lit(0))
    side = template.withColumn("__tmask", mask_of)
    cond = F.col("__probe.__mask") == F.col("__tmask")
    for f, t in exact.items():
        cond = cond & (F.col(f) == F.col(t))
    for i, t in enumerate(dims.values()):
        cond = cond & (F.col(f"__probe.__d{i}") == F.col(t))
    matched = probes.join(side, cond)
    return matched.select(*facts.columns, *take)


def join_bucket(
    facts: DataFrame, buckets: DataFrame, keys: dict[str, str], amount: Column, low: str, high: str, bucket_id: str,
    name: str, default: int, *, half_open: bool,
) -> DataFrame:
    """Bucket id of an amount inside [low, high) or [low, high]; the narrowest wins, none gives ``default``.

    The different amounts of a key find their bucket as points find ranges: amounts and buckets are never paired.
    Without ``keys`` there is one list, which goes into the plan.
    """
    entry = F.struct((F.col(high) - F.col(low)).alias("width"), F.col(bucket_id).alias("id"), F.col(low).alias("lo"), F.col(high).alias("hi"))
    listed = buckets.where(F.col(low).isNotNull() & F.col(high).isNotNull())
    if keys:
        placed = facts.withColumn("__amount", amount)
        side = listed.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(keys.values())], entry.alias("__entry")).select("*", "__entry.*")
        points = placed.select(*keys, "__amount").distinct()
        equal = {k: f"__b{i}" for i, k in enumerate(keys)}
        best = best_of_each(points, side, [*keys, "__amount"], "__amount", "lo", "hi", [F.col("__entry")], ["id"], equal=equal, half_open=half_open)
        found = lookup_join(placed, best, [*keys, "__amount"], {"id": "__id"})
        return found.withColumn(name, F.coalesce("__id", F.lit(default)).cast("int")).drop("__id", "__amount")
    cells = [F.struct(*[F.lit(v).alias(k) for k, v in r["e"].asDict().items()]) for r in listed.select(entry.alias("e")).collect()]
    if not cells:
        return facts.withColumn(name, F.lit(default).cast("int"))
    found = facts.withColumn("__buckets", F.array(*cells)).withColumn("__amount", amount)

    def holds(b: Column) -> Column:
        value = F.col("__amount")
        return (value >= b["lo"]) & ((value < b["hi"]) if half_open else (value <= b["hi"]))

    best = F.array_min(F.filter("__buckets", holds))["id"]
    return found.withColumn(name, F.coalesce(best, F.lit(default)).cast("int")).drop("__buckets", "__amount")


def require_unique(df: DataFrame, keys: list[str], label: str) -> None:
    """Raise when a key repeats."""
    repeated = df.groupBy(*keys).count().where("count > 1").take(1)
    if repeated:
        raise InputError(f"{label}: keys {keys} repeat, e.g. {repeated[0]}")


def consolidate(base: DataFrame, stages: list[tuple[str, DataFrame]], keys: list[str], check: bool = True) -> DataFrame:
    """Base rows with the new columns of derived stages; derived keys must be unique."""
    for label, stage in stages:
        if check:
            require_unique(stage, keys, label)
        fresh = [c for c in stage.columns if c not in base.columns]
        base = base.join(stage.select(*keys, *fresh), keys, "left")
    return base


def join_suffixing(left: DataFrame, right: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """Left join where colliding columns of the left side take a suffix."""
    clashes = {c: c + suffix for c in left.columns if c in right.columns and c not in keys}
    return left.withColumnsRenamed(clashes).join(right, keys, "left")


def flag_hierarchy(df: DataFrame, parent: str, node: str, name: str) -> DataFrame:
    """10 for a root (reports to itself), 1 for a node others report to, 0 for a leaf or unknown columns."""
    if parent not in df.columns or node not in df.columns:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    parents = df.where(F.col(parent) != F.col(node)).select(F.col(parent).alias("__p")).distinct()
    joined = lookup_join(df.withColumn("__n", F.col(node)), parents.withColumn("__is", F.lit(1)), {"__n": "__p"}, ["__is"])
    level = F.when(F.col(parent) == F.col(node), 10).when(F.col("__is").isNotNull(), 1).otherwise(0)
    return joined.withColumn(name, level.cast("bigint")).drop("__n", "__is")


def flag_listed(df: DataFrame, listed: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """1 where the row's keys are listed, else 0."""
    distinct = listed.select(*keys.values()).distinct().withColumn("__is", F.lit(1))
    joined = lookup_join(df, distinct, keys, ["__is"])
    return joined.withColumn(name, F.coalesce("__is", F.lit(0)).cast("bigint")).drop("__is")


def overlay(base: DataFrame, delta: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """New value where the delta has one, else the old (base column -> delta column)."""
    take = {d: f"__new_{b}" for b, d in columns.items()}
    joined = lookup_join(base, delta, keys, take)
    for b in columns:
        joined = joined.withColumn(b, F.coalesce(F.col(f"__new_{b}"), F.col(b)))
    return joined.drop(*take.values())


def file_status(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """new, duplicate or new version, by file id and content hash."""
    known = ledger.groupBy("file_id").agg(F.max_by("content_hash", "registered_at").alias("known_hash"))
    joined = lookup_join(incoming, known, ["file_id"], ["known_hash"])
    status = F.when(F.col("known_hash").isNull(), "new").when(F.col("known_hash") == F.col("content_hash"), "duplicate").otherwise("new version")
    return joined.withColumn("status", status).drop("known_hash")


def subtable_records(details: DataFrame, catalog: DataFrame, table_id: str) -> DataFrame:
    """Detail records of one sub-table, found through each file's own catalog."""
    wanted = catalog.where(F.col("table_ipm_id") == table_id).select("file_id", "table_sub_id").distinct()
    return lookup_join(details, wanted, {"file_id": "file_id", "record_table_id": "table_sub_id"}, {}, how="left_semi")


def codes_of_pair(rates: DataFrame, currencies: DataFrame) -> DataFrame:
    """Numeric codes for both currencies of a rate."""
    single = currencies.groupBy(F.trim("currency_alphabetic_code").alias("alpha")).agg(
        F.min(F.trim(F.col("currency_numeric_code").cast("string"))).alias("num")
    )
    with_from = lookup_join(rates, single, {"from_currency": "alpha"}, {"num": "from_currency_numeric_code"})
    return lookup_join(with_from, single, {"to_currency": "alpha"}, {"num": "to_currency_numeric_code"})


def attach_cost(detail: DataFrame, costs: DataFrame, keys: list[str], cost: str, name: str) -> DataFrame:
    """Unit cost by key, 0 where none is known; both sides share unique keys."""
    plain = detail.drop(name).join(costs.select(*keys, F.col(cost).alias(name)), keys, "left")
    return plain.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast(costs.schema[cost].dataType)))
