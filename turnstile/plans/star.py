"""Star schema: the sales fact and five dimensions."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import OPEN_END
from ..functions import commission, date_parts, surrogate_key
from ..operators.incremental import incremental_rows
from ..operators.joins import effective_join, lookup_join
from ..operators.latest import latest_by
from ..schemas import FACT, SALES_COLUMNS

#: What the fact takes from the unified sales.
FACT_INPUT = [c for c in SALES_COLUMNS if c in FACT.fieldNames()]


def sales_key() -> Column:
    """Key of a fact row, which follows from two of its columns."""
    return surrogate_key("sales_id", "sales_source")


def current_agreements(agreements: DataFrame) -> DataFrame:
    """Latest version per organizer, reseller and start date.

    A missing change time counts as newest; the agreement id settles ties.
    """
    newest = [
        F.col("updated_at").desc_nulls_first(),
        F.col("agreement_id").desc_nulls_last(),
    ]
    keys = ["organizer_id", "reseller_id", "effective_from"]
    return latest_by(agreements, keys, newest).select(
        *keys, "effective_to", "commission_rate"
    )


def rated_sales(
    sales: DataFrame,
    agreements: DataFrame,
    at: str = "sales_date",
    spread: Sequence[str] = ("sales_id",),
    hot: Sequence[int] = (),
) -> DataFrame:
    """Sales with the commission rate in force, null where no agreement holds."""
    return effective_join(
        sales,
        current_agreements(agreements),
        ["organizer_id", "reseller_id"],
        at,
        spread=spread,
        hot=hot,
        measure=True,
    )


def changed_periods(old: DataFrame, new: DataFrame) -> DataFrame:
    """Periods of pairs in which a rate may differ between two states of the
    agreements: those of versions in force that came, went or changed."""
    before, after = current_agreements(old), current_agreements(new)
    changed = before.exceptAll(after).unionByName(after.exceptAll(before))
    return changed.select("organizer_id", "reseller_id", "effective_from", "effective_to").distinct()


def sales_in_periods(sales: DataFrame, periods: DataFrame, at: str = "sales_date") -> DataFrame:
    """Sales that fall into one of the periods of their pair, each once."""
    until = F.coalesce(F.col("effective_to"), F.lit(OPEN_END).cast("date"))
    within = (F.col(at) >= F.col("effective_from")) & (F.col(at) <= until)
    keys = {k: k for k in ("organizer_id", "reseller_id")}
    return lookup_join(sales, periods, keys, "left_semi", within, measure=True)


def rerated_sales(sales: DataFrame, changed: DataFrame, periods: DataFrame, single: bool = False) -> DataFrame:
    """All sales rows of the keys that are in ``changed`` or fall into ``periods``.

    Whole keys, so that their fact rows can replace the stored ones. ``single``: no key
    has several rows, so that each row is a whole key and need not meet others.
    """
    keys = ["sales_id", "sales_source"]
    if single:
        on = {k: k for k in keys}
        known = lookup_join(sales, changed, on, "left_semi", measure=True)
        fallen = sales_in_periods(sales.dropna(subset=keys), periods)
        return known.unionByName(lookup_join(fallen, changed, on, "left_anti", measure=True))
    wanted = changed.select(*keys).unionByName(sales_in_periods(sales, periods).select(*keys))
    return lookup_join(sales, wanted, {k: k for k in keys}, "left_semi")


def fact_ticket_sales(
    sales: DataFrame,
    agreements: DataFrame,
    target: DataFrame | None = None,
    mark: Column | None = None,
    lateness: str | None = None,
    by: str | None = None,
    hot: Sequence[int] = (),
) -> DataFrame:
    """Fact rows; with a target or a mark, those changed since (incremental).

    The incremental filter is on the sale, so it runs before the joins.
    """
    if target is not None or mark is not None:
        sales = incremental_rows(sales, target, mark=mark, lateness=lateness, by=by)
    zero = F.lit(0)
    rated = rated_sales(sales, agreements, hot=hot)
    shaped = rated.withColumns(
        {
            "sales_key": sales_key(),
            "quantity": F.coalesce("quantity", zero),
            "unit_price": F.coalesce("unit_price", zero),
            "total_amount": F.coalesce("total_amount", zero),
            "commission_rate": F.coalesce("commission_rate", zero),
            "commission_amount": commission("total_amount", "commission_rate"),
        }
    )
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in FACT])


def dim_customer(customers: DataFrame) -> DataFrame:
    return (
        customers.select("customer_id", "first_name", "last_name", "email")
        .dropna(subset=["customer_id"])
        .distinct()
    )


def dim_organizer(organizers: DataFrame) -> DataFrame:
    return (
        organizers.select("organizer_id", "organizer_name", "region")
        .dropna(subset=["organizer_id"])
        .distinct()
    )


def dim_reseller(resellers: DataFrame) -> DataFrame:
    return (
        resellers.select("reseller_id", "reseller_name", "region", "country")
        .dropna(subset=["reseller_id"])
        .distinct()
    )


def dim_event(events: DataFrame, organizers: DataFrame) -> DataFrame:
    kept = events.dropna(subset=["event_id"])
    joined = lookup_join(
        kept,
        organizers.select("organizer_id", "organizer_name"),
        {"organizer_id": "organizer_id"},
        spread=["event_id"],
    )
    return joined.select(
        "event_id", "event_name", "event_type", "event_date", "venue", "region",
        "organizer_id", "organizer_name",
    ).distinct()


def dim_date(sales: DataFrame) -> DataFrame:
    """Dates on which something was sold.

    The date settles all other columns, so only it is made distinct and the
    parts are computed once per date.
    """
    dates = sales.select(F.col("sales_date").alias("date_key"))
    return (
        dates.dropna().distinct().select("date_key", *[
            c.alias(n) for n, c in date_parts("date_key").items()
        ])
    )


def star_schema(staged: Mapping[str, DataFrame], sales: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_ticket_sales": fact_ticket_sales(sales, staged["commission_agreements"]),
        "dim_customer": dim_customer(staged["customers"]),
        "dim_organizer": dim_organizer(staged["organizers"]),
        "dim_reseller": dim_reseller(staged["resellers"]),
        "dim_event": dim_event(staged["events"], staged["organizers"]),
        "dim_date": dim_date(sales),
    }
