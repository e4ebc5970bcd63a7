"""Aligning payments, revenue, transactions, contracts, renewals, risk and usage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.coerce import nan_to_null
from tidemark.functions.text import canonical_list
from tidemark.functions.weeks import as_column, earliest, months_between_30, days_between, week_midpoint
from tidemark.operators.relational import (
    active_only,
    dedupe_most_complete,
    full_outer_by_date,
    keep_known,
    numeric_columns,
    select_existing,
)
from tidemark.operators.scale import attach_group_stats, fan_out_join, settled


@dataclass(frozen=True)
class Bundle:
    """The input tables of a load.

    ``account(account_id, account_name, segment, segment_level, churned_flag, churn_date)``
    ``payment(customer_no, receipt_date, amounts...)``
    ``revenue(account_id, invoice_date, amounts...)``
    ``txn(account_number, trx_date, amounts...)``
    ``contract_line(account_id, line_start, line_end, line_status)``
    ``renewal(bill_to, coverage_start, coverage_end)``
    ``risk(account_number, ...)``: one row per account
    ``usage(account_id, yyyywk, contract_start, line_items, churn_date, metrics...)``
    ``first_week(account_id, yyyywk)``: first active week
    """

    account: DataFrame
    payment: DataFrame
    revenue: DataFrame
    txn: DataFrame
    contract_line: DataFrame
    renewal: DataFrame
    risk: DataFrame
    usage: DataFrame
    first_week: DataFrame

    def live(self) -> "Bundle":
        """The same bundle for accounts that have not churned."""
        accounts = active_only(self.account)
        return Bundle(
            accounts,
            self.payment,
            self.revenue,
            self.txn,
            self.contract_line,
            self.renewal,
            self.risk,
            self.usage.join(accounts.select("account_id"), "account_id", "left_semi"),
            self.first_week.join(accounts.select("account_id"), "account_id", "left_semi"),
        )


def clean_usage(usage: DataFrame, since: str = "2020-01-01", mode: str = "column") -> DataFrame:
    """Usage with canonical item lists, one row per account and week.

    Contracts from before ``since`` drop out.  Exact copies need no separate
    distinct step: the grouping by account and week absorbs them.
    """
    recent = usage.where(F.col("contract_start") >= F.lit(since).cast("date"))
    return dedupe_most_complete(recent, ["account_id", "yyyywk"], "line_items", mode, normal=canonical_list)


def sum_by_key_date(df: DataFrame, key: str, date: str, metrics: list[str] | None = None) -> DataFrame:
    """Sums per key and date of the listed metrics, or of all numeric columns.

    Without any numeric column the rows are counted.  NaN counts as NULL; all-NULL
    metrics sum to 0; rows with a NULL key or date drop out.
    """
    chosen = numeric_columns(df, exclude=(key, date)) if metrics is None else metrics
    grouped = nan_to_null(df).dropna(subset=[key, date]).groupBy(key, date)
    if not chosen:
        return grouped.agg(F.count(F.lit(1)).alias("count"))
    return grouped.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in chosen])


def dated_sums(
    facts: DataFrame, accounts: DataFrame, fact_key: str, date: str, metrics: list[str], distinct: bool = True
) -> DataFrame:
    """Sums per known account and date, with the date repeated as ``month``.

    Accounts are matched after the summing: what meets the account list is one
    row per account and date, so an account with a third of all facts is no
    heavier there than any other.  With ``distinct``, repeated fact rows count once.
    """
    rows = facts.distinct() if distinct else facts
    summed = sum_by_key_date(rows, fact_key, date, metrics)
    return keep_known(summed, fact_key, accounts).withColumn("month", F.col(date))


def with_bounds(df: DataFrame, key: str, start: str, end: str, prefix: str) -> DataFrame:
    """Earliest start and latest end of the key on each of its rows."""
    return attach_group_stats(
        df, [key], **{f"{prefix}_earliest": F.min(start), f"{prefix}_latest": F.max(end)}
    )


def bounds(df: DataFrame, key: str, start: str, end: str, prefix: str) -> DataFrame:
    """Earliest start and latest end, one row per key."""
    return (
        df.dropna(subset=[key])
        .groupBy(key)
        .agg(F.min(start).alias(f"{prefix}_earliest"), F.max(end).alias(f"{prefix}_latest"))
    )


def financial_timeline(b: Bundle) -> DataFrame:
    """Payments, revenue and transactions side by side per account and date."""
    return full_outer_by_date(
        [
            dated_sums(b.payment, b.account, "customer_no", "receipt_date", ["functional_amount"]),
            dated_sums(b.revenue, b.account, "account_id", "invoice_date", ["revline_total"]),
            dated_sums(b.txn, b.account, "account_number", "trx_date", ["amount_due"]),
        ],
        "account_id",
        "month",
    )


#: The one metric of each source that weekly features are made of.
STANDARD_METRICS = {"payment": ["functional_amount"], "revenue": ["revline_total"], "txn": ["amount_due"]}


#: The bit of usage among those that say which sources a day has; facts and lines have the lower ones.
_USAGE = 16
#: Columns of usage that a merge leaves out.
_LEFT_OUT = ("contract_number", "contract_end")


def _dated(b: Bundle, taken: set[str], metrics: dict[str, list[str]] | None, columns: list[str] | None) -> tuple[DataFrame, dict[str, list[Column]]]:
    """Payments, revenue, transactions and contract lines stacked as rows of (account, day, source, metrics), with what each source's columns are made of.

    Facts are summed per account and day.  Repeated fact rows count once; dealing rows
    by account and day serves both the search for repeats and the sum, so raw facts
    are shuffled once.  A metric whose name is taken gets its source's name in front.
    A source's own date is the day of its rows, so it need not travel.
    """
    parts: list[DataFrame] = []
    made: dict[str, list[Column]] = {}

    def own_date(df: DataFrame, date: str) -> Column:
        here = F.col("_sources").bitwiseAND(1 << len(parts)) > 0
        return F.when(here, F.col("month")).cast(df.schema[date].dataType).alias(date)

    def facts(source: str, df: DataFrame, key: str, date: str) -> None:
        chosen = numeric_columns(df, exclude=(key, date)) if metrics is None else metrics[source]
        rows = df.select(key, date, *[c for c in df.columns if c not in (key, date)]).repartition(key, date).distinct()
        summed = sum_by_key_date(rows, key, date, chosen)
        names = {c: f"{source}_{c}" if c in taken else c for c in summed.columns if c not in (key, date)}
        taken.update(names.values())
        names = {c: n for c, n in names.items() if columns is None or n in columns}
        made[source] = [own_date(df, date), *[F.col(n) for n in names.values()]]
        own = [F.col(c).alias(n) for c, n in names.items()]
        parts.append(summed.select(F.col(key).alias("account_id"), F.col(date).alias("month"), F.lit(1 << len(parts)).alias("_source"), *own))

    facts("payment", b.payment, "customer_no", "receipt_date")
    facts("revenue", b.revenue, "account_id", "invoice_date")
    facts("txn", b.txn, "account_number", "trx_date")
    made["contract_line"] = [own_date(b.contract_line, "line_start")]
    lines = b.contract_line.select("account_id", F.col("line_start").alias("month")).distinct()
    parts.append(lines.withColumn("_source", F.lit(1 << len(parts))))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts), made


def timeline(
    b: Bundle, since: str, metrics: dict[str, list[str]] | None = None, columns: list[str] | None = None, written: bool = False
) -> DataFrame:
    """All dated sources of the known accounts side by side, one row per account and day; ``_dated`` if not of usage alone.

    Each source has at most one row per account and day once its facts are
    summed, so a chain of full outer joins on account and day is the same as
    stacking the sources and looking at each day once.  Usage, one row per account and
    week by then, is stacked with them; what is stacked is dealt by account, which all
    later steps ask for, so it is shuffled once.  The calendar bounds an account's rows.
    Usage of an unreadable week meets nothing.  ``metrics`` lists what to sum per
    source; without it, all numeric columns are summed.

    ``columns`` lists those of usage and of the metrics that are wanted, if not all are.
    With ``written``, the sums and the usage are written as tables before they are stacked, so that
    the shuffles of each are gone from the disk when the next step begins.
    """
    usage = nan_to_null(clean_usage(b.usage, since))
    kept = [c for c in usage.columns if c not in _LEFT_OUT and (columns is None or c in ("account_id", "yyyywk", *columns))]
    dated, made = _dated(b, {*usage.columns, "usage_month", "month", "line_start"}, metrics, columns)
    usage = usage.select(*kept)
    if written:
        dated, usage = settled(dated, "dated"), settled(usage, "usage")
    values = [c for c in dated.columns if c not in ("account_id", "month", "_source")]
    weeks = usage.withColumns({"month": week_midpoint("yyyywk"), "_source": F.lit(_USAGE)})
    stacked = dated.unionByName(weeks, allowMissingColumns=True).repartition("account_id")
    of_usage = F.col("_source") == _USAGE
    day = W.partitionBy("account_id", "month", F.col("month").isNull() & of_usage)
    met = stacked.withColumns({"_sources": F.bit_or("_source").over(day), **{c: F.max(c).over(day) for c in values}})
    # A day's usage rows stay, else the row of its first source.
    first = F.col("_sources").bitwiseAND(F.col("_source") + (_USAGE - 1)) == 0
    days = met.where(of_usage | first).select(
        "account_id",
        "month",
        *[c for source in made.values() for c in source],
        (F.col("_sources") != _USAGE).alias("_dated"),
        *[c for c in kept if c != "account_id"],
        F.when(of_usage, F.col("month")).cast("date").alias("usage_month"),
    )
    # An inner join, since a semi join would be pushed below the sums, where accounts meet raw facts.
    return days.join(b.account.select("account_id").distinct(), "account_id")


def _lifetime(merged: DataFrame, as_of: str | None) -> DataFrame:
    start = as_column("final_earliest_date")
    if as_of is None:
        timed = {"lifespan_months": months_between_30(start, "churn_date"), "days_to_churn": days_between(start, "churn_date")}
    else:
        day = F.lit(as_of).cast("date")
        timed = {"months_elapsed": months_between_30(start, day), "days_elapsed": days_between(start, day)}
    return merged.withColumns(timed)


ROW_DATES = ("receipt_date", "invoice_date", "trx_date", "line_start", "coverage_start")


def merge_sources(
    b: Bundle,
    since: str = "2020-01-01",
    renewals: str = "bounds",
    as_of: str | None = None,
    metrics: dict[str, list[str]] | None = None,
    columns: list[str] | None = None,
    written: bool = False,
) -> DataFrame:
    """All sources of a bundle aligned on account and date.

    Of payments, revenue and transactions all numeric columns are summed, or those
    that ``metrics`` lists per source.

    ``renewals='rows'`` repeats every row for each renewal of its account; an account
    with many rows and many renewals is dealt over many tasks.
    ``'bounds'`` carries one row of renewal bounds instead, which leaves all
    later results the same and cannot blow up on an account with many renewals.
    Renewals and risk go to the rows that have a payment, invoice, transaction
    or contract line; rows of usage alone lack them.
    With ``as_of`` the lifetime columns measure time up to that day (live
    accounts) instead of up to the churn date.
    ``columns`` lists the columns that are wanted, if not all are; with ``written`` the steps
    before the sources meet are written as tables, with no other columns.
    """
    accounts = b.account.select("account_id")
    covers = b.renewal.distinct().withColumnRenamed("bill_to", "account_id")
    cover = bounds(covers, "account_id", "coverage_start", "coverage_end", "renewal").withColumn(
        "coverage_start", F.col("renewal_earliest")
    )
    risk = keep_known(b.risk.distinct(), "account_number", accounts)
    # The flag sits in the join condition, not in the key: usage-only rows keep their
    # account's hash and find no partner.
    merged = timeline(b, since, metrics, None if columns is None else [*columns, "churn_date"], written)
    for other in (cover, risk):
        other = other.withColumnRenamed("account_id", "_k")
        merged = merged.join(other, (F.col("account_id") == F.col("_k")) & F.col("_dated"), "left").drop("_k")
    # One row per account and day is left here: the calendar bounds the window, and
    # no two rows are the same.  The earliest of an account's renewals is among the bounds,
    # so rows are repeated last, for each distinct start, and stay distinct.
    merged = merged.withColumn("_earliest", earliest(*ROW_DATES))
    merged = merged.withColumn("final_earliest_date", F.min("_earliest").over(W.partitionBy("account_id"))).drop("_earliest")
    if renewals == "rows":
        starts = covers.select("account_id", "coverage_start").distinct()
        dated = F.coalesce("_dated", F.lit(False))
        merged = fan_out_join(merged.drop("coverage_start"), starts, "account_id", dated, by=["month", "yyyywk"])
    merged = _lifetime(merged.drop("_dated"), as_of)
    return merged if columns is None else select_existing(merged, columns)
