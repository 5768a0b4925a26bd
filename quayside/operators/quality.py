"""Data-quality checks and profiles of container visits.

Checks come out in one long table (check, level, column, metric, value) with
levels ok < info < warning < error. All per-row rules are counted by a single
aggregate over the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside import schema as S
from quayside.functions import visit as V
from quayside.functions.exact import quantiles
from quayside.session import broadcastable, cut_lineage
from quayside.sources.visits import POSITION, RAW, RAW_OUT

CHECK_SCHEMA = "check string, level string, column string, metric string, value double"
KEY = ["container_id", "gate_in_time"]
MIN_CONTAINERS, MIN_SPAN_DAYS, MIN_BLOCKS = 100, 30, 2
REQUIRED_NULL_ERROR_PCT, REQUIRED_NULL_WARNING_PCT = 20, 10
OPEN_WARNING_PCT, REVERSED_ERROR_PCT = 30, 5
HEAVY_TONS, LIGHT_TONS = 40, 1


def _moment(as_of: str | None) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()


def data_columns(df: DataFrame) -> list[str]:
    """The columns of the input, known and unknown, without keys and helpers we added."""
    added = {"visit_id", POSITION, *RAW.values()}
    known = [c for c in S.REQUIRED_COLUMNS + S.OPTIONAL_COLUMNS if c in df.columns]
    return known + [f.name for f in df.schema.fields if f.name not in added and f.name not in known
                    and f.dataType.typeName() not in ("map", "array", "struct", "variant")]


def source_order(df: DataFrame) -> list[Column]:
    """A total order that follows the source files where the position is known."""
    order = [F.col(POSITION)] if POSITION in df.columns else []
    if "visit_id" in df.columns:
        order.append(F.col("visit_id"))
    return order


def is_reversed() -> Column:
    return F.coalesce(F.col("gate_out_time") < F.col("gate_in_time"), F.lit(False))


def is_future(column: str, as_of: str | None) -> Column:
    return F.coalesce(F.col(column) > _moment(as_of), F.lit(False))


def keep_first(visits: DataFrame, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """The first row of every key, nulls being equal.

    ``row_number() = 1`` lets Spark keep only one row per key and map task
    before the shuffle, so copies of a hot key never meet in one task.
    """
    order = Window.partitionBy(*keys).orderBy(
        *(source_order(visits) or [F.col(c) for c in visits.columns]))
    return (visits.withColumn("_n", F.row_number().over(order))
            .where(F.col("_n") == 1).drop("_n"))


def _same_key() -> Column:
    """Whether a visit has the key of a row of ``repeated_keys``, nulls being equal."""
    same_key = F.lit(True)
    for c in KEY:
        same_key = same_key & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same_key


def repeated_keys(visits: DataFrame) -> DataFrame:
    """The keys that occur more than once, with their rows. Keys are counted on the map side first."""
    return (visits.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1)
            .select("n", *[F.col(c).alias(f"_{c}") for c in KEY]))


def clean_visits(visits: DataFrame, as_of: str | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """Visits without duplicates, reversed intervals and future timestamps.

    A duplicate is judged over all rows, before the other exclusions. Exact
    copies share their key, so the key alone finds both kinds. Where the stored
    ``repeated_keys`` are given and few, only the visits under them are shuffled.
    """
    bad = is_reversed() | is_future("gate_in_time", as_of) | is_future("gate_out_time", as_of)
    if repeated is None or not broadcastable(repeated):
        return keep_first(visits).where(~bad)
    once = visits.join(repeated, _same_key(), "left_anti")
    return once.unionByName(keep_first(visits.join(repeated, _same_key(), "left_semi"))).where(~bad)


def excluded_visits(visits: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows dropped by date rules, with the reason (duplicates not included)."""
    return visits.withColumns({
        "is_reversed": is_reversed().cast("int"),
        "is_future_in": is_future("gate_in_time", as_of).cast("int"),
        "is_future_out": is_future("gate_out_time", as_of).cast("int"),
    }).where(F.greatest("is_reversed", "is_future_in", "is_future_out") == 1)


def duplicate_counts(visits: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Surplus exact copies and surplus rows per key (one row).

    Exact copies share their key, so whole rows are only compared under keys
    that occur more than once. Equal rows are merged on the map side before
    anything is shuffled. ``repeated_keys`` that are stored can be given.
    """
    repeated = repeated_keys(visits) if repeated is None else repeated
    exact = (
        visits.join(repeated, _same_key(), "left_semi")
        .groupBy(*[F.col(f"`{c}`") for c in data_columns(visits)]).agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).scalar()
    )
    return repeated.agg(
        exact.alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("key_duplicates"))


class _Checks:
    """Collects counters and the rows made from them."""

    def __init__(self) -> None:
        self.counters: dict[str, Column] = {"total_rows": F.count(F.lit(1))}
        self.rows: list[tuple[str, str, str, Column, Column]] = []

    def count(self, name: str, condition: Column) -> Column:
        self.counters[name] = F.count_if(condition)
        return F.col(name)

    def row(self, check: str, column: str, metric: str, value: Column, level: Column) -> None:
        self.rows.append((check, column, metric, value, level))

    def flag(self, check: str, column: str, condition: Column, level: str = "warning") -> None:
        """A count that raises ``level`` when it is not zero."""
        n = self.count(f"{check}__{column}", condition)
        self.row(check, column, "rows", n, _level(n > 0, level))

    def counted(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        return df.groupBy(*keys).agg(*[c.alias(n) for n, c in self.counters.items()])

    def table(self, df: DataFrame) -> DataFrame:
        return self.checks(self.counted(df))

    def checks(self, counted: DataFrame) -> DataFrame:
        return counted.select(F.inline(F.array(*[
            F.struct(F.lit(check).alias("check"), level.alias("level"),
                     F.lit(column).alias("column"), F.lit(metric).alias("metric"),
                     value.cast("double").alias("value"))
            for check, column, metric, value, level in self.rows])))


def _level(condition: Column, level: str, otherwise: Column | str = "ok") -> Column:
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(condition, level).otherwise(rest)


def _pct(part: Column, whole: str = "total_rows") -> Column:
    return F.try_divide(part, F.col(whole)) * 100


def _outside(column: str, domain: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*domain)


def schema_checks(spark, columns: Sequence[str]) -> DataFrame:
    """Required columns that are missing (errors) and optional ones that are there."""
    rows = [("missing_column", "error", c, "missing", 1.0)
            for c in S.missing_required(list(columns))]
    rows += [("optional_column", "ok", c, "present", 1.0)
             for c in S.present_optional(list(columns))]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def row_checks(visits: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every rule that can be judged on a single row, from one pass."""
    return row_rules(visits, as_of).table(visits)


def row_rules(visits: DataFrame, as_of: str | None = None) -> _Checks:
    """Counters of the rules on single rows, all of which add up over parts of the visits."""
    c, present = _Checks(), set(visits.columns)
    total = F.col("total_rows")
    c.row("total_rows", "*", "rows", total, F.lit("ok"))

    for column, domain in (
        ("size_ft", S.SIZES), ("container_type", S.CONTAINER_TYPES),
        ("movement_type", S.MOVEMENT_TYPES), ("gate_in_mode", S.GATE_MODES),
        ("gate_out_mode", S.GATE_MODES),
    ):
        if column in present:
            bad = _outside(column, domain)
            if RAW.get(column) in present:  # text that is no number is no valid size either
                bad = bad | (F.col(RAW[column]).isNotNull() & F.col(column).isNull())
            c.flag("domain", column, bad)
    c.flag("non_positive", "weight_tons", F.col("weight_tons") <= 0)

    for column in data_columns(visits):
        source = RAW.get(column, column)
        source = source if source in present else column
        n = c.count(f"nulls__{column}", F.col(f"`{source}`").isNull())
        pct = F.round(_pct(n), 2)
        if column == "gate_out_time":
            level = _level(pct > OPEN_WARNING_PCT, "warning")
        elif column in S.REQUIRED_COLUMNS:
            level = _level(pct > REQUIRED_NULL_ERROR_PCT, "error",
                           _level(pct > REQUIRED_NULL_WARNING_PCT, "warning"))
        else:
            level = F.lit("ok")
        c.row("nulls", column, "rows", n, F.lit("ok"))
        c.row("nulls", column, "pct", pct, level)

    c.flag("unreadable", "gate_in_time", F.col("gate_in_time").isNull(), "error")
    if RAW_OUT in present:
        c.flag("unreadable", "gate_out_time",
               F.col(RAW_OUT).isNotNull() & F.col("gate_out_time").isNull())
    n = c.count("reversed", is_reversed())
    c.row("reversed", "gate_out_time", "rows", n,
          _level(_pct(n) > REVERSED_ERROR_PCT, "error", _level(n > 0, "warning")))
    c.row("reversed", "gate_out_time", "pct", _pct(n), F.lit("ok"))
    for column in ("gate_in_time", "gate_out_time"):
        c.flag("future", column, is_future(column, as_of))
    c.flag("overweight", "weight_tons", F.col("weight_tons") > HEAVY_TONS)
    c.flag("underweight", "weight_tons", F.col("weight_tons") < LIGHT_TONS)
    return c


def duplicate_checks(visits: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    counts = duplicate_counts(visits, repeated)
    rows = [
        F.struct(F.lit(name).alias("check"), _level(F.col(name) > 0, "warning").alias("level"),
                 F.lit(column).alias("column"), F.lit("rows").alias("metric"),
                 F.col(name).cast("double").alias("value"))
        for name, column in (("exact_duplicates", "*"),
                             ("key_duplicates", "container_id,gate_in_time"))]
    return counts.select(F.inline(F.array(*rows)))


def coverage(clean: DataFrame) -> DataFrame:
    """Rows, distinct containers and blocks, and the gate-in range (one row)."""
    # Distinct values are counted over the pairs that occur, not over the rows.
    pairs = clean.groupBy("container_id", "yard_block").agg(
        F.count(F.lit(1)).alias("n"), F.min("gate_in_time").alias("lo"), F.max("gate_in_time").alias("hi"))
    lo, hi = F.min("lo"), F.max("hi")
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_rows"),
        F.count_distinct("container_id").alias("unique_containers"),
        F.count_distinct("yard_block").alias("unique_blocks"),
        F.to_date(lo).alias("start_date"), F.to_date(hi).alias("end_date"),
        F.floor(F.timestamp_diff("SECOND", lo, hi) / 86400).alias("span_days"))


def minimum_checks(clean: DataFrame) -> DataFrame:
    """Enough containers, days and blocks among the clean rows."""
    def row(check: str, column: str, metric: str, level: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), level.alias("level"),
                        F.lit(column).alias("column"), F.lit(metric).alias("metric"),
                        F.col(metric).cast("double").alias("value"))

    return coverage(clean).select(F.inline(F.array(
        row("valid_rows", "*", "valid_rows", F.lit("ok")),
        row("minimum", "container_id", "unique_containers",
            _level(F.col("unique_containers") < MIN_CONTAINERS, "error")),
        row("minimum", "gate_in_time", "span_days",
            _level(F.col("span_days") < MIN_SPAN_DAYS, "error")),
        row("minimum", "yard_block", "unique_blocks",
            _level(F.col("unique_blocks") < MIN_BLOCKS, "warning")))))


def documented_checks(visits: DataFrame, as_of: str | None = None) -> DataFrame:
    """Checks the documentation names beyond the ones that decide the status."""
    c, present = _Checks(), set(visits.columns)
    days = V.dwell_hours() / 24.0
    c.flag("very_long_dwell", "gate_out_time", days > 365, "info")
    read = c.count("read_in", F.col("gate_in_time").isNotNull())
    c.row("read_rate", "gate_in_time", "pct", _pct(read), F.lit("ok"))
    c.counters["span_days"] = F.timestamp_diff(
        "SECOND", F.min("gate_in_time"), F.max("gate_in_time")) / 86400.0
    c.row("containers_per_day", "container_id", "mean",
          F.try_divide(F.col("total_rows"), F.col("span_days")), F.lit("ok"))
    if "iso_type_code" in present:
        code = F.col("iso_type_code")
        c.flag("iso_mismatch", "size_ft", V.iso_size(code) != F.col("size_ft"), "info")
        c.flag("iso_mismatch", "container_type",
               V.iso_group(code, F.lit(None).cast("string")) != F.col("container_type"), "info")
    return c.table(visits)


def quality_checks(visits: DataFrame, as_of: str | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """All checks that decide the status of a data set.

    The visits are written once, with the columns that the checks read, and all checks read them there.
    Visits that files hold already are read from those, if their ``repeated_keys`` are given, stored too; the
    checks are then made in turn, so that rows shuffled for one need not be kept beside those of the next.
    """
    if repeated is not None:
        return (row_checks(visits, as_of)
                .unionByName(cut_lineage(duplicate_checks(visits, repeated)))
                .unionByName(cut_lineage(minimum_checks(clean_visits(visits, as_of, repeated)))))
    used = {"visit_id", POSITION, *RAW.values(), *data_columns(visits)}
    void = {f.name for f in visits.schema.fields if f.dataType.typeName() == "void"}  # parquet has no such type
    visits = cut_lineage(visits.select(*[
        F.col(f"`{c}`").cast("string").alias(c) if c in void else F.col(f"`{c}`")
        for c in visits.columns if c in used or not source_order(visits)]))
    return (row_checks(visits, as_of)
            .unionByName(duplicate_checks(visits))
            .unionByName(minimum_checks(clean_visits(visits, as_of))))


def status(checks: DataFrame) -> DataFrame:
    """FAIL on any error, WARN on any warning, PASS otherwise (one row)."""
    return checks.agg(
        F.count_if(F.col("level") == "error").alias("errors"),
        F.count_if(F.col("level") == "warning").alias("warnings"),
    ).withColumn("status", F.when(F.col("errors") > 0, "FAIL")
                 .when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


def quality_score(checks: DataFrame) -> DataFrame:
    """Share of the checks that passed, in percent."""
    passed = F.col("level").isin("ok", "info").cast("int")
    return checks.agg((F.avg(passed) * 100).alias("quality_score_pct"))


def report_shares(visits: DataFrame, as_of: str | None = None) -> DataFrame:
    """Excluded share of the rows and share of open visits, in percent."""
    kept = clean_visits(visits, as_of).agg(F.count(F.lit(1))).scalar()
    return visits.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("gate_out_time").isNull()).alias("open_visits"),
    ).withColumn("valid_rows", kept).select(
        "total_rows", "valid_rows",
        (F.col("total_rows") - F.col("valid_rows")).alias("excluded_rows"),
        (F.try_divide(F.col("total_rows") - F.col("valid_rows"), "total_rows") * 100)
        .alias("excluded_pct"),
        (F.try_divide("open_visits", "total_rows") * 100).alias("open_pct"))


def invalid_values(visits: DataFrame, most: int = 5) -> DataFrame:
    """The first few offending values per text column, in order of appearance."""
    pairs = F.inline(F.array(*[
        F.struct(F.lit(column).alias("column"),
                 F.when(_outside(column, domain), F.col(column)).alias("value"))
        for column, domain in (("container_type", S.CONTAINER_TYPES),
                               ("movement_type", S.MOVEMENT_TYPES))]))
    position = F.struct(*source_order(visits)) if source_order(visits) else F.lit(0)
    first = Window.partitionBy("column").orderBy("first_seen", "value")
    return (
        visits.select(position.alias("seen"), pairs).where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("seen").alias("first_seen"))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= most)
        .select("column", "rank", "value", "rows")
    )


# --- profiles ----------------------------------------------------------------

def adjusted_skewness(column: Column) -> Column:
    """Bias-corrected sample skewness; null below three values."""
    n = F.count(column).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n > 2, F.skewness(column) * factor)


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, places: int = 2) -> DataFrame:
    """Count, range, mean, median, deviation and skewness per numeric column.

    Null and NaN are missing. An infinite value counts, and is a range's end or a median; it
    leaves a column without a deviation and a skewness, and its mean is infinite (or null
    where both infinities occur).
    """
    columns = [c for c in (columns or S.NUMERIC_PROFILE_COLUMNS) if c in df.columns]
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    finite = lambda c: F.when(F.abs(number(c)) < float("inf"), number(c))
    whole = lambda c: F.count(number(c)) == F.count(finite(c))
    ends = lambda c: F.max(number(c)) + F.min(number(c))  # noqa: E731 - NaN where both ends are infinite
    stats = {
        "count": lambda c: F.count(number(c)), "min": lambda c: F.min(number(c)), "max": lambda c: F.max(number(c)),
        "mean": lambda c: F.when(whole(c), F.avg(finite(c))).otherwise(F.nanvl(ends(c), F.lit(None).cast("double"))),
        "std": lambda c: F.when(whole(c), F.stddev_samp(finite(c))),
        "skewness": lambda c: F.when(whole(c), adjusted_skewness(finite(c))),
    }
    wide = df.agg(*[f(c).alias(f"{c}__{name}") for c in columns for name, f in stats.items()])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 *[F.col(f"{c}__{name}").alias(name) for name in stats])
        for c in columns])))
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    medians = quantiles(values, "value", [0.5], ["column"]).select(
        "column", F.col("quantile").alias("median"))
    rounded = lambda x: F.when(F.abs(x) < 1e300, F.round(x, places)).otherwise(x)
    return long.join(medians, "column", "left").select(
        "column", "count", *[
            rounded(F.col(name)).alias(name)
            for name in ("min", "max", "mean", "median", "std", "skewness")])


def _value_counts(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    columns = [c for c in (columns or S.CATEGORICAL_PROFILE_COLUMNS) if c in df.columns]
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns]))
    return (df.select(pairs).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows")))


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null count and number of distinct values per text column."""
    return _value_counts(df, columns).groupBy("column").agg(
        F.sum("rows").alias("count"), F.count(F.lit(1)).alias("unique"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, most: int = 10) -> DataFrame:
    """The most frequent values per text column."""
    by_count = Window.partitionBy("column").orderBy(F.desc("rows"), F.asc("value"))
    return (_value_counts(df, columns)
            .withColumn("rank", F.row_number().over(by_count))
            .where(F.col("rank") <= most))
