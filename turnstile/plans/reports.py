"""Business reports over the star schema.

Reports that need a dimension first total the fact per dimension key, then join
the far fewer totals to the dimension and total again. A key that holds a third
of all sales so reaches the join as one row, and sums stay exact.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safe_divide, week_start
from ..operators.aggregates import (
    filtered_totals,
    labelled_counts,
    top_k,
    top_k_per,
    totals,
)
from ..operators.joins import lookup_join


def _parts() -> dict[str, Column]:
    """Sums from which every measure follows, so totals can be totalled again."""
    return {
        "_total": F.sum("total_amount"),
        "_tickets": F.sum("quantity"),
        "_commission": F.sum("commission_amount"),
        "_rate": F.sum("commission_rate"),
        "_rates": F.count("commission_rate"),
        "_rows": F.count("*"),
    }


def _measures() -> dict[str, Column]:
    total, commission = F.sum("_total"), F.sum("_commission")
    return {
        "total_sales": total,
        "net_sales": total - commission,
        "tickets_sold": F.sum("_tickets"),
        "commission_amount": commission,
        "avg_commission_rate": safe_divide(
            F.sum("_rate").cast("double"), F.sum("_rates")
        ),
        "transactions": F.sum("_rows"),
    }


def partials(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums by some columns of the fact, small enough to keep; see ``from_partials``."""
    return totals(fact, list(by), _parts())


def from_partials(kept: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Measures from partial sums, by columns that these are grouped by."""
    if not by:
        return kept.agg(*[c.alias(n) for n, c in _measures().items()])
    return totals(kept, list(by), _measures())


def measures(fact: DataFrame) -> DataFrame:
    """All measures over the whole fact, in one row."""
    return fact.agg(*[c.alias(n) for n, c in _parts().items()]).agg(
        *[c.alias(n) for n, c in _measures().items()]
    )


def report(
    fact: DataFrame,
    by: Sequence[str],
    dims: Mapping[str, DataFrame] | None = None,
    where: str | None = None,
    top: int | None = None,
    order: str = "total_sales",
) -> DataFrame:
    """Measures by any columns of the fact and its dimensions.

    dims   {key column: dimension}; a sale without a match drops out
    where  SQL condition over dimension columns and the fact's group columns
    top    only the first groups by a measure, ties in group order
    """
    dims = dims or {}
    week = "week" in by and "week" not in fact.columns
    if week:
        fact = fact.withColumn("week", week_start("sales_date"))
    plain = [c for c in fact.columns if c in by]
    keys = list(dict.fromkeys([*dims, *plain]))
    grouped = totals(fact, keys, _parts()) if keys else fact.agg(
        *[c.alias(n) for n, c in _parts().items()]
    )
    for key, dim in dims.items():
        extra = [c for c in dim.columns if c == key or c not in grouped.columns]
        grouped = lookup_join(grouped, dim.select(*extra), {key: key}, "inner")
    if where:
        grouped = grouped.where(where)
    result = totals(grouped, list(by), _measures())
    if top is None:
        return result
    ranking = [F.col(order).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in by]]
    return top_k(result, ranking, top)


def weekly_by_channel(fact: DataFrame) -> DataFrame:
    return report(fact, ["week", "sales_channel"])


def month_comparison(
    fact: DataFrame, month: int = 2, year: int = 2020, base_year: int = 2019, amount: str = "total_amount"
) -> DataFrame:
    """Sales of a month against the same month of another year, in one pass."""
    d = F.col("sales_date")

    def in_month(y: int) -> Column:
        return (F.year(d) == y) & (F.month(d) == month)

    # The sale dates of interest reach the reader as plain ranges.
    def span(y: int) -> Column:
        first = F.make_date(F.lit(y), F.lit(month), F.lit(1))
        return (d >= first) & (d <= F.last_day(first))

    both = fact.where(span(year) | span(base_year))
    sums = filtered_totals(
        both,
        F.col(amount),
        {"current_sales": in_month(year), "base_sales": in_month(base_year)},
    )
    change = F.col("current_sales") - F.col("base_sales")
    return sums.withColumn("difference", change).withColumn(
        "change_share",
        safe_divide(change.cast("double"), F.col("base_sales").cast("double")),
    )


def sales_for(
    fact: DataFrame,
    dim_event: DataFrame,
    dim_reseller: DataFrame,
    resellers: Sequence[str] | None = None,
    event_types: Sequence[str] | None = None,
) -> DataFrame:
    """Measures by reseller and event type, for chosen ones or all."""
    if resellers is not None:
        fact = fact.where(F.col("reseller_id").isin(list(resellers)))
    if event_types is not None:
        dim_event = dim_event.where(F.col("event_type").isin(list(event_types)))
    return report(
        fact,
        ["reseller_id", "reseller_name", "event_type"],
        {
            "event_id": dim_event.select("event_id", "event_type"),
            "reseller_id": dim_reseller.select("reseller_id", "reseller_name"),
        },
    )


def commission_bands(fact: DataFrame) -> DataFrame:
    """Sales by commission rate, in bands of one percentage point."""
    banded = fact.withColumn("rate_band", F.floor("commission_rate").cast("int"))
    return report(banded, ["rate_band"])


def commission_by_reseller(fact: DataFrame) -> DataFrame:
    return report(fact.dropna(subset=["reseller_id"]), ["reseller_id"])


def popular_events(fact: DataFrame, dim_event: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` events of each region that sold most tickets."""
    per_event = totals(fact, ["event_id"], {"_tickets": F.sum("quantity")})
    named = lookup_join(
        per_event,
        dim_event.select("event_id", "event_name", "region"),
        {"event_id": "event_id"},
        "inner",
    )
    sold = totals(
        named, ["region", "event_id", "event_name"], {"tickets_sold": F.sum("_tickets")}
    )
    order = [F.col("tickets_sold").desc_nulls_last(), F.col("event_id").asc()]
    return top_k_per(sold, ["region"], order, k)


def revenue_by_year(sales: DataFrame, date: str = "purchase_date") -> DataFrame:
    return totals(
        sales,
        [F.year(date).alias("sales_year")],
        {
            "transactions": F.count("*"),
            "tickets_sold": F.sum("quantity"),
            "revenue": F.round(F.sum("total_amount"), 2),
        },
    ).orderBy("sales_year")


def top_by_revenue(
    sales: DataFrame,
    ref: DataFrame,
    key: str,
    label: str,
    k: int = 10,
    amount: str = "total_amount",
) -> DataFrame:
    """Labels with the largest revenue; equal labels count together."""
    per_key = totals(sales, [key], {"_revenue": F.sum(amount)})
    named = lookup_join(per_key, ref.select(key, label), {key: key}, "inner")
    revenue = totals(named, [label], {"revenue": F.round(F.sum("_revenue"), 2)})
    return top_k(revenue, [F.col("revenue").desc(), F.col(label).asc()], k)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return labelled_counts(tables)
