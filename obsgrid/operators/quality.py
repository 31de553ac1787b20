"""Declarative data-quality rules. A rule yields rows, never a side effect.

Reports share one shape: (dataset, rule, observed, expected, status).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import count_if, is_nonfinite, one_row, window_days
from obsgrid.schema import KEY, MEASURE_NAMES, MEASURES


@dataclass(frozen=True)
class Rule:
    """An aggregate that must equal a constant, or stay within a bound."""

    name: str
    observed: Column
    expected: Column
    test: str = "equal"

    def holds(self) -> Column:
        if self.test == "at least":
            return self.observed >= self.expected
        if self.test == "at most":
            return self.observed <= self.expected
        return self.observed.eqNullSafe(self.expected)


def report(facts: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """Rules over a single row of facts, one report row each."""
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("rule"),
            r.observed.cast("string").alias("observed"),
            r.expected.cast("string").alias("expected"),
            F.when(r.holds(), "PASS").otherwise("FAIL").alias("status"),
        )
        for r in rules
    ]
    return facts.select(F.inline(F.array(*rows)))


def out_of_order() -> Column:
    """min <= mean <= max is broken; rows with a missing temperature do not count."""
    low, mid, high = F.col("temperature_min"), F.col("temperature_mean"), F.col("temperature_max")
    return F.coalesce((low > mid) | (mid > high), F.lit(False))


def range_consistency(daily: DataFrame) -> DataFrame:
    """Violations of min <= mean <= max, together and one by one."""
    low, mid, high = F.col("temperature_min"), F.col("temperature_mean"), F.col("temperature_max")
    return daily.agg(
        count_if(out_of_order()).alias("violations"),
        count_if(low > mid).alias("min_above_mean"),
        count_if(mid > high).alias("mean_above_max"),
        count_if(low > high).alias("min_above_max"),
    )


def duplicate_groups(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def duplicate_extra_rows(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows beyond the first of their key."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("extra_rows")
    )


def nonfinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN or infinite values per column."""
    counted = df.agg(*[count_if(is_nonfinite(F.col(c))).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nonfinite")


def missing_cells(columns: Sequence[str]) -> Column:
    """NULL or NaN cells of a row."""
    return sum(
        (F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0) for c in columns), F.lit(0)
    )


def count_offenders(per_place: DataFrame, count: str, expected: int | Column) -> DataFrame:
    """Places whose observation count is not the expected one."""
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    return per_place.withColumn("expected", wanted.cast("long")).where(
        F.col(count) != F.col("expected")
    )


def continuity(daily: DataFrame) -> DataFrame:
    """Rows and distinct days per place against the span of the whole table."""
    bounds = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    per_day = daily.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    return (
        per_day.groupBy("location_id")
        .agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("days"))
        .withColumn("_span", one_row(bounds, "first", "last"))
        .withColumn("expected_days", window_days(F.col("_span.first"), F.col("_span.last")).cast("long"))
        .withColumn(
            "complete",
            (F.col("rows") == F.col("expected_days")) & (F.col("days") == F.col("expected_days")),
        )
        .drop("_span")
    )


def date_gaps(daily: DataFrame) -> DataFrame:
    """Runs of missing days per place within the span of the whole table.

    Each day looks at the next observed one, so nothing is expanded to a full calendar: the
    result has one row per gap. Repeated days are folded before the window, which bounds a
    place's group by the calendar. Gaps before a place's first day and after its last are
    included.
    """
    bounds = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    span = one_row(bounds, "first", "last")
    order = Window.partitionBy("location_id").orderBy("date")
    days = daily.select(*KEY).distinct().withColumn("_span", span)
    following = days.withColumns(
        {
            "_next": F.lead("date").over(order),
            "_previous": F.lag("date").over(order),
        }
    )

    def gap(start: Column, end: Column) -> Column:
        return F.struct(start.alias("gap_start"), end.alias("gap_end"))

    after = gap(
        F.date_add("date", 1),
        F.coalesce(F.date_sub("_next", 1), F.col("_span.last")),
    )
    before = gap(F.col("_span.first"), F.date_sub("date", 1))
    gaps = F.array(after, F.when(F.col("_previous").isNull(), before))
    return (
        following.select("location_id", F.explode(gaps).alias("gap"))
        .where(F.col("gap.gap_start") <= F.col("gap.gap_end"))
        .select(
            "location_id",
            "gap.gap_start",
            "gap.gap_end",
            window_days(F.col("gap.gap_start"), F.col("gap.gap_end")).alias("missing_days"),
        )
    )


def missing_dates(gaps: DataFrame) -> DataFrame:
    """The missing days themselves, from their gaps."""
    return gaps.select("location_id", F.explode(F.sequence("gap_start", "gap_end")).alias("date"))


def daily_facts(daily: DataFrame, measures: Sequence[str] = MEASURE_NAMES) -> DataFrame:
    """Everything the table's rules need, from one fold by place and day and one by place."""
    per_day = daily.groupBy("location_id", "city", "date").agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum(missing_cells(measures)).alias("missing"),
        count_if(out_of_order()).alias("inconsistent"),
    )
    per_place = per_day.groupBy("location_id", "city").agg(
        F.sum("copies").alias("rows"),
        F.count(F.lit(1)).alias("days"),
        F.sum("missing").alias("missing"),
        F.sum("inconsistent").alias("inconsistent"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )
    return per_place.agg(
        F.sum("rows").alias("rows"),
        F.count_distinct("location_id").alias("locations"),
        F.count_distinct("city").alias("cities"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.sum(F.col("rows") - F.col("days")).alias("duplicates"),
        F.sum("missing").alias("missing"),
        F.sum("inconsistent").alias("inconsistent"),
        F.min("rows").alias("fewest_rows"),
        F.max("rows").alias("most_rows"),
        F.min("days").alias("fewest_days"),
    )


def daily_report(
    daily: DataFrame,
    dataset: str,
    locations: int | Column,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The whole table's report; expected rows follow from places times the observed span."""
    wanted = (locations if isinstance(locations, Column) else F.lit(locations)).cast("long")
    facts = daily_facts(daily).withColumn("wanted", wanted)
    span = window_days(F.col("min_date"), F.col("max_date")).cast("long")
    zero = F.lit(0).cast("long")
    rules = [
        Rule("rows", F.col("rows"), F.col("wanted") * span),
        Rule("locations", F.col("locations"), F.col("wanted")),
        Rule("cities", F.col("cities"), F.col("wanted")),
        Rule("duplicates", F.col("duplicates"), zero),
        Rule("missing_values", F.col("missing"), zero),
        Rule("temperature_consistency", F.col("inconsistent"), zero),
        Rule("fewest_rows_per_location", F.col("fewest_rows"), span),
        Rule("most_rows_per_location", F.col("most_rows"), span),
        Rule("fewest_days_per_location", F.col("fewest_days"), span),
    ]
    if start is not None:
        rules.append(Rule("minimum_date", F.col("min_date"), F.lit(start).cast("date")))
    if end is not None:
        rules.append(Rule("maximum_date", F.col("max_date"), F.lit(end).cast("date")))
    return report(facts, dataset, rules)


def feature_report(features: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    """A profile table's rules: unique ids and no missing values."""
    per_id = features.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum(missing_cells(columns)).alias("missing")
    )
    facts = per_id.agg(
        F.sum(F.col("copies") - 1).alias("duplicates"), F.sum("missing").alias("missing")
    )
    zero = F.lit(0).cast("long")
    return report(
        facts,
        dataset,
        [
            Rule("duplicate_ids", F.col("duplicates"), zero),
            Rule("missing_values", F.col("missing"), zero),
        ],
    )


def assignment_report(
    assigned: DataFrame, dataset: str, k: int, rows: int, expected: Sequence[int] = ()
) -> DataFrame:
    """Cluster ids inside 0..k-1, all used, every place assigned, and clusters of the expected
    sizes, by id, where they are given."""
    cluster = F.col("cluster_id")
    sizes = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    facts = sizes.agg(
        F.sum("size").alias("rows"),
        count_if(cluster.between(0, k - 1)).alias("used"),
        F.sum(F.when(~cluster.between(0, k - 1) | cluster.isNull(), F.col("size")).otherwise(0)).alias(
            "outside"
        ),
        *[
            F.coalesce(F.sum(F.when(cluster == i, F.col("size"))), F.lit(0)).alias(f"size_{i}")
            for i in range(len(expected))
        ],
    )
    return report(
        facts,
        dataset,
        [
            Rule("rows", F.col("rows"), F.lit(rows).cast("long")),
            Rule("clusters_used", F.col("used"), F.lit(k).cast("long")),
            Rule("ids_outside_range", F.col("outside"), F.lit(0).cast("long")),
            *[
                Rule(f"size_{i}", F.col(f"size_{i}"), F.lit(n).cast("long"))
                for i, n in enumerate(expected)
            ],
        ],
    )


def payload_violations(
    payloads: DataFrame, expected_locations: Column, strict_dates: bool = False
) -> DataFrame:
    """Rule violations of parsed payloads: (work_id, position, rule, observed, expected).

    Columns needed: work_id, start_date, end_date, locations, and whatever
    ``expected_locations`` refers to. ``strict_dates`` asks for the exact list of days.
    """
    days = window_days(F.col("start_date"), F.col("end_date"))

    def violation(rule: str, broken: Column, observed: Column, expected: Column) -> Column:
        return F.when(
            F.coalesce(broken, F.lit(False)),
            F.struct(
                F.lit(rule).alias("rule"),
                observed.cast("string").alias("observed"),
                expected.cast("string").alias("expected"),
            ),
        )

    count = F.size(F.coalesce("locations", F.array()))
    per_file = payloads.select(
        "work_id",
        F.lit(0).alias("position"),
        F.inline(
            F.array_compact(
                F.array(
                    violation("location_count", count != expected_locations, count, expected_locations)
                )
            )
        ),
    )
    place = payloads.select(
        "work_id",
        "start_date",
        "end_date",
        days.alias("days"),
        F.posexplode("locations").alias("index", "location"),
    ).withColumn("position", F.col("index") + 1)
    daily = F.col("location.daily")
    time = F.coalesce(daily["time"], F.array().cast("array<string>"))
    first = F.date_format("start_date", "yyyy-MM-dd")
    last = F.date_format("end_date", "yyyy-MM-dd")
    calendar = F.transform(
        F.sequence("start_date", "end_date"), lambda d: F.date_format(d, "yyyy-MM-dd")
    )
    has_daily = daily.isNotNull()
    has_days = F.size(time) > 0
    checks = [
        violation(f"missing_{field}", F.col(f"location.{field}").isNull(), F.lit(None), F.lit(field))
        for field in ("latitude", "longitude", "timezone")
    ]
    checks.append(violation("missing_daily", ~has_daily, F.lit(None), F.lit("daily")))
    checks.append(
        violation("day_count", has_daily & (F.size(time) != F.col("days")), F.size(time), F.col("days"))
    )
    for m in MEASURES:
        values = daily[m.variable]
        checks.append(
            violation(f"missing_{m.variable}", has_daily & values.isNull(), F.lit(None), F.lit(m.variable))
        )
        checks.append(
            violation(
                f"length_{m.variable}",
                has_daily & (F.size(values) != F.size(time)),
                F.size(values),
                F.size(time),
            )
        )
    distinct = F.size(F.array_distinct(time))
    checks += [
        violation("duplicate_dates", distinct != F.size(time), distinct, F.size(time)),
        violation("no_dates", has_daily & ~has_days, F.lit(0), F.col("days")),
        violation("first_date", has_days & (F.get(time, F.lit(0)) != first), F.get(time, F.lit(0)), first),
        violation(
            "last_date", has_days & (F.try_element_at(time, F.lit(-1)) != last),
            F.try_element_at(time, F.lit(-1)), last,
        ),
    ]
    if strict_dates:
        checks.append(
            violation("exact_dates", has_daily & (time != calendar), F.size(time), F.col("days"))
        )
    per_place = place.select(
        "work_id", "position", F.inline(F.array_compact(F.array(*checks)))
    )
    return per_file.unionByName(per_place)


def envelope_violations(envelopes: DataFrame) -> DataFrame:
    """Envelopes whose ids and locations differ in number, or that lack either."""
    ids = F.size(F.coalesce("envelope.location_ids", F.array().cast("array<bigint>")))
    places = F.size(F.coalesce("envelope.locations", F.array()))
    return envelopes.select("work_id", ids.alias("ids"), places.alias("locations")).where(
        F.col("ids") != F.col("locations")
    )


def fast_hash(names: Sequence[str]) -> Column:
    """Hash of a row. Hash functions skip NULLs, so the columns' NULL flags are hashed along:
    a NULL that moves to another column changes the hash."""
    return F.xxhash64(F.array(*[F.isnull(n) for n in names]), *names)


def text_hash(names: Sequence[str]) -> Column:
    """Hash that any engine with MD5 can repeat: the first 60 bits over the values as text,
    each marked as present or NULL."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("~")) for n in names]
    digits = F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def fingerprint(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    row_hash: Callable[[Sequence[str]], Column] = fast_hash,
) -> DataFrame:
    """Order-free digest of a table's rows; equal tables give equal digests.

    Sum and exclusive-or of row hashes need no sort and combine per task.
    """
    names = sorted(columns or df.columns)
    row = row_hash(names)
    return df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(
            "hash_sum"
        ),
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("hash_xor"),
    )


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows; used to skip publishing what did not change."""
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        return False
    return fingerprint(left, columns).first() == fingerprint(right, columns).first()
